"""Chat formatting by quotation linking.

A message is cut into its lines; leading ``>`` marks give a line's quote level. Neighbouring lines of one level are a
passage, normalised (marks off, all white space as one space, A-Z lower-cased). Its windows of ``WINDOW`` words are
hashed, so that neither another wrapping nor a partial quote matters, and so are its lines, its short sentences and
itself if it is shorter than a window; the same is done to the unquoted passages of every message. A message replies
to the earlier message of its conversation that holds most of the characters it quotes at the first level; short pieces
only count where nothing longer is found, and deeper levels, being quotes of quotes, where the first level finds nothing. A message without a match
starts a thread at its own turn. Every message comes after what it replies to in the order of thread and turn; its
depth is the number of replies above it. All of it is DataFrame work.

Defined results: a null text is empty; a null conversation or turn is kept, has no parent and is never one; of rows
that repeat a conversation and turn one is used as the original, all are kept; a message of quotes alone has an empty
body; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import discard, settle, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Shorter pieces (normalised characters) only count where nothing longer of their level is found.
LEAST = 12
#: Words of a window, turns of a block.
WINDOW, BLOCK = 5, 1024
MARKS = r"^[ \t]*((?:>[ \t]?)*)"


def lines(text: Column) -> Column:
    """array<struct<level, body>>: the quote level of each line and what follows its marks."""
    return F.transform(
        F.split(F.coalesce(text, F.lit("")), "\n"),
        lambda x: F.struct(
            F.length(F.regexp_replace(F.regexp_extract(x, MARKS, 1), "[^>]", "")).alias("level"),
            F.when(x.rlike(r"^[ \t]*>"), F.regexp_replace(x, MARKS, "")).otherwise(x).alias("body"),
        ),
    )


def normal(body: Column) -> Column:
    return F.trim(F.regexp_replace(F.translate(body, UPPER, LOWER), r"[\x20\x09-\x0D]+", " "))


def _pieces(read: DataFrame, quoted: bool) -> DataFrame:
    """(conv_id, turn, level, passage, at, words, weak): lines, windows and short sentences of the quoted, or of the unquoted, passages.

    ``at`` is the place of a window's first word in its passage, -1 for other pieces.
    """
    levels = F.filter(F.array_distinct(F.transform("lines", lambda x: x["level"])), lambda x: (x > 0) if quoted else (x == 0))
    told = read.select("conv_id", "turn", "lines", F.explode(levels).alias("level"))
    # lines of other levels part the passages
    split = F.split(F.array_join(F.transform("lines", lambda x: F.when(x["level"] == F.col("level"), F.translate(x["body"], "\0", " ")).otherwise("\0")), "\n"), "\0")
    parts = told.select("conv_id", "turn", "level", F.posexplode(split).alias("passage", "text")).withColumn("whole", normal(F.col("text")))
    parts = parts.where("whole != ''").withColumn("each", F.split("whole", " "))
    piece = lambda at, words, weak: F.struct(at.cast("int").alias("at"), words.alias("words"), weak.alias("weak"))
    none, n = F.lit(-1), F.size("each")
    plain = lambda x, weak: piece(none, x, weak | (F.length(x) < LEAST))
    lines_ = F.transform(F.split("text", "\n"), lambda x: plain(normal(x), F.lit(False)))
    sentences = F.transform(F.filter(F.split("whole", r"(?<=[.!?]) "), lambda x: F.size(F.split(x, " ")) < WINDOW), lambda x: plain(x, F.lit(True)))
    short = F.when(n < WINDOW, F.array(plain(F.col("whole"), F.lit(False)))).otherwise(F.array().cast("array<struct<at:int,words:string,weak:boolean>>"))
    windows = F.when(n >= WINDOW, F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: piece(i, F.array_join(F.slice("each", i + 1, WINDOW), " "), F.lit(False)))).otherwise(F.array().cast("array<struct<at:int,words:string,weak:boolean>>"))
    rows = parts.select("conv_id", "turn", "level", "passage", F.explode(F.concat(lines_, sentences, short, windows)).alias("p"))
    # a piece without a letter or digit (a rule, a fence) says nothing
    return rows.select("conv_id", "turn", "level", "passage", "p.*").where(F.col("words").rlike(r"[\p{L}\p{N}]")).withColumns({"h1": F.xxhash64("words"), "h2": F.hash("words")})


def _latest(quotes: DataFrame, originals: DataFrame) -> DataFrame:
    """(conv_id, turn, h1, h2, parent): for each quoted piece the last original before it in its conversation.

    An as-of join in two steps, so that a piece that a conversation repeats very often is neither paired with all its
    quotes nor sorted at once: within blocks of ``BLOCK`` turns, and from the last originals of the blocks before.
    """
    block = F.floor(F.col("turn") / BLOCK).alias("block")
    piece = ["conv_id", "h1", "h2"]
    asked = quotes.select(*piece, "turn", block, F.lit(None).cast("long").alias("parent"))
    given = originals.select(*piece, F.col("parent").alias("turn"), "parent").select(*piece, "turn", block, F.col("parent").cast("long").alias("parent"))
    within = Window.partitionBy(*piece, "block").orderBy(F.col("turn").cast("long")).rangeBetween(Window.unboundedPreceding, -1)
    near = asked.withColumn("quote", F.lit(True)).unionByName(given.withColumn("quote", F.lit(False))).withColumn("near", F.max("parent").over(within)).where("quote").drop("quote", "parent")
    ends = given.groupBy(*piece, "block").agg(F.max("parent").alias("last")).unionByName(asked.select(*piece, "block", F.lit(None).cast("long").alias("last")).distinct())
    before = Window.partitionBy(*piece).orderBy("block").rangeBetween(Window.unboundedPreceding, -1)
    far = ends.groupBy(*piece, "block").agg(F.max("last").alias("last")).withColumn("far", F.max("last").over(before)).where("far is not null").drop("last")
    found = near.join(far, [*piece, "block"], "left").withColumn("parent", F.coalesce("near", "far"))
    return found.where("parent is not null").select("conv_id", "turn", "h1", "h2", "parent")


def parents(read: DataFrame) -> DataFrame:
    """(conv_id, turn, parent, quoted_chars) for the messages whose quotes are found."""
    quotes = settle(_pieces(read, True))
    # only pieces that are quoted at all are of use; equal pieces of one conversation: the last one before the quote
    asked = quotes.select("conv_id", "h1", "h2").distinct()
    originals = _pieces(read, False).select("conv_id", F.col("turn").alias("parent"), "h1", "h2").join(asked, ["conv_id", "h1", "h2"], "left_semi").distinct()
    last = _latest(quotes.select("conv_id", "turn", "h1", "h2").distinct(), settle(originals))
    found = settle(quotes.join(last, ["conv_id", "turn", "h1", "h2"]))
    # words that several windows hold count once, and so do lines that are repeated
    word = F.posexplode(F.split("words", " ")).alias("i", "word")
    one = found.where("at >= 0").select("conv_id", "turn", "parent", "level", "passage", "at", "weak", word)
    one = one.select("conv_id", "turn", "parent", "level", "weak", "passage", (F.col("at") + F.col("i")).alias("i"), (F.length("word") + 1).alias("chars")).distinct()
    lines_ = found.where("at < 0").groupBy("conv_id", "turn", "parent", "h1", "h2").agg(F.min("level").alias("level"), F.min("weak").alias("weak"), F.max(F.length("words")).alias("chars"))
    both = one.select("conv_id", "turn", "parent", "level", "weak", "chars", F.lit(True).alias("window")).unionByName(lines_.select("conv_id", "turn", "parent", "level", "weak", "chars", F.lit(False).alias("window")))
    kinds = {"direct": F.col("level") == 1, "chars": F.lit(True)}
    sums = [F.sum(F.when(is_ & (F.col("window") == w) & ~(F.col("weak") & strong), F.col("chars")).otherwise(0)).alias(f"{k}{int(strong)}{int(w)}") for k, is_ in kinds.items() for strong in (False, True) for w in (False, True)]
    votes = both.groupBy("conv_id", "turn", "parent").agg(*sums)
    most = lambda k, strong: F.greatest(f"{k}{strong}0", f"{k}{strong}1").alias(f"{k}{strong}")
    best = votes.groupBy("conv_id", "turn").agg(F.max(F.struct(most("direct", 1), most("direct", 0), most("chars", 1), most("chars", 0), "parent")).alias("best"))
    return best.select("conv_id", "turn", F.col("best.parent").alias("parent"), F.col("best.chars0").alias("quoted_chars"))


def link(messages: DataFrame) -> DataFrame:
    """Every message without its quotes, with its parent, the first message of its thread and its depth there.

    Threads and depths grow by doubling: a chain of n replies takes log2(n) joins, and a row never holds more than two
    numbers of its path.
    """
    read = messages.select("conv_id", "turn", "role", lines(F.col("text")).alias("lines"))
    found = settle(parents(read))
    paths = settle(found.select("conv_id", "turn", F.col("parent").alias("top"), F.lit(1).cast("long").alias("depth")))
    while True:
        up = paths.select("conv_id", F.col("turn").alias("top"), F.col("top").alias("higher"), F.col("depth").alias("above"))
        grown = settle(paths.join(up, ["conv_id", "top"], "left").select("conv_id", "turn", F.coalesce("higher", "top").alias("top"), (F.col("depth") + F.coalesce("above", F.lit(0))).alias("depth"), F.col("above").isNotNull().alias("moved")))
        discard(paths)
        paths = grown.drop("moved")
        if not grown.where("moved").limit(1).count():
            break
    body = F.array_join(F.transform(F.filter("lines", lambda x: x["level"] == 0), lambda x: x["body"]), "\n")
    deepest = F.array_max(F.transform("lines", lambda x: x["level"]))
    shown = read.select("conv_id", "turn", "role", F.trim(F.regexp_replace(body, r"\n{3,}", "\n\n")).alias("body"), deepest.alias("quote_depth"))
    told = settle(found.join(paths, ["conv_id", "turn"]))
    none = F.lit(0).cast("long")
    return shown.join(told, ["conv_id", "turn"], "left").select(
        "conv_id", "turn", "role", "body", "quote_depth",
        F.col("parent").alias("parent_turn"),
        F.coalesce("quoted_chars", none).cast("long").alias("quoted_chars"),
        F.coalesce("top", "turn").alias("thread_turn"),
        F.coalesce("depth", none).alias("depth"),
    )


def op5_quote_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link(table(spark, sf_dir, "conversations"))


QUERIES = {"op5_quote_links": op5_quote_links}
