"""Quoted passages that aren't the same lines as in the message they come from."""

from __future__ import annotations

from terroir.llm import quote_links as Q

LONG = "The blade should be held at twenty degrees\nand drawn over the stone in long strokes until it\ntakes a burr on the other side."


def test_quotes_of_passages(spark):
    rows = [
        (1, 0, LONG), (1, 1, "Sure, why?"), (1, 2, "Fine."),
        (1, 3, "> The blade should be\n> held at twenty degrees and drawn over\n> the stone in long strokes until\n> it takes a burr on the other side.\nIs that so?"),
        (1, 4, "> Sure, why?\nBecause."), (1, 5, "> drawn over the stone in long strokes\nHow long?"),
        (2, 0, "Buy:\n- figs\n- rye\n- tea"), (2, 1, "ok"), (2, 2, "> - figs\n> - rye\n> - tea\nno tea"), (2, 3, "> ---\nrule"), (2, 4, "> nothing that anyone has said before\nhm"),
        (3, 0, LONG), (3, 1, "yes"), (3, 2, "> yes\n> The blade should be held at twenty degrees\nbut"),
    ]
    df = spark.createDataFrame([(c, t, "user", x) for c, t, x in rows], "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.turn): r for r in Q.link(df).collect()}
    assert len(got) == len(rows)
    assert [got[1, t].parent_turn for t in range(6)] == [None, None, None, 0, 1, 0]
    assert [got[2, t].parent_turn for t in range(5)] == [None, None, 0, None, None]
    assert got[3, 2].parent_turn == 0
    assert got[1, 4].quoted_chars == len("Sure, why?")
