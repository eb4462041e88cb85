"""Language ID by a byte convolutional network, trained in numpy on labelled text.

A text is cut into windows of ``WINDOW`` bytes, all of them, the last one padded. Bytes are embedded, filters of
several widths run over the window, each filter's largest answer is kept, and a softmax over those gives the window's
languages. A text's score is the mean over its windows, weighted by their bytes.

For prediction the embedding and the filters are folded into tables indexed by pairs of bytes, so a filter of width 4
costs two look-ups and an addition.

Defined results: a null text and one without any letter are ``und`` with score 0; so is every text if there is no
labelled text to learn from; repeated ids are judged row by row; a null id is never learned from and not held out;
extra columns are ignored by the query and kept by ``keep_known``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import give_back, slices, table, text_bytes

WINDOW, EMBEDDING, WIDTHS, FILTERS = 256, 8, (2, 3, 4), 16
#: The sample that the network is trained on: about so many documents of each language, so many windows of each.
SAMPLE_DOCS, SAMPLE_WINDOWS = 600, 2
#: Languages that are learned at most, those of most documents first.
MOST_LANGUAGES = 1000
EPOCHS, BATCH, RATE = 6, 64, 0.004
#: Windows that one numpy step holds.
STEP = 512


@dataclass(frozen=True)
class Network:
    """Weights: embedding (256, E); for each width filters (width, E, F) and biases (F); dense (all F, languages)."""

    languages: tuple[str, ...]
    embedding: np.ndarray
    filters: tuple[np.ndarray, ...]
    biases: tuple[np.ndarray, ...]
    dense: np.ndarray
    offset: np.ndarray

    def key(self) -> tuple:
        return (self.languages, *(a.tobytes() for a in (self.embedding, *self.filters, *self.biases, self.dense, self.offset)))


def windows_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of all texts as (n, WINDOW) bytes, the text each belongs to, and how many bytes it really has."""
    counts = np.array([max(1, -(-len(t) // WINDOW)) for t in texts], np.int64)
    joined = b"".join(t.ljust(int(n) * WINDOW, b"\0") for t, n in zip(texts, counts, strict=True))
    owner = np.repeat(np.arange(len(texts)), counts)
    size = np.full(len(owner), WINDOW, np.int64)
    if len(texts):
        size[np.cumsum(counts) - 1] = [max(1, len(t) - (int(n) - 1) * WINDOW) for t, n in zip(texts, counts, strict=True)]
    return np.frombuffer(joined, np.uint8).reshape(-1, WINDOW), owner, size


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def train(windows: np.ndarray, labels: np.ndarray, languages: tuple[str, ...], seed: int = 7) -> Network:
    """Fit the network with Adam; the gradient of max pooling flows through the largest answer alone."""
    rng = np.random.default_rng(seed)
    n_out = len(WIDTHS) * FILTERS
    params = {"embedding": rng.normal(0, 0.3, (256, EMBEDDING)), "dense": rng.normal(0, 0.1, (n_out, len(languages))), "offset": np.zeros(len(languages))}
    for w in WIDTHS:
        params[f"filter{w}"] = rng.normal(0, (1 / (w * EMBEDDING)) ** 0.5, (w * EMBEDDING, FILTERS))
        params[f"bias{w}"] = np.zeros(FILTERS)
    params = {k: v.astype(np.float32) for k, v in params.items()}
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in params.items()}
    step = 0
    for _ in range(EPOCHS):
        for rows in np.array_split(rng.permutation(len(windows)), max(1, len(windows) // BATCH)):
            x, y = windows[rows], labels[rows]
            embedded = params["embedding"][x]
            grads = {k: np.zeros_like(v) for k, v in params.items()}
            pooled, kept = [], []
            for w in WIDTHS:
                view = np.concatenate([embedded[:, k : WINDOW - w + 1 + k] for k in range(w)], 2)
                answer = view @ params[f"filter{w}"]
                at = answer.argmax(1)
                top = np.take_along_axis(answer, at[:, None], 1)[:, 0] + params[f"bias{w}"]
                kept.append((view, at))
                pooled.append(top)
            features = np.maximum(np.concatenate(pooled, 1), 0)
            out = _softmax(features @ params["dense"] + params["offset"])
            out[np.arange(len(y)), y] -= 1
            out /= len(y)
            grads["dense"], grads["offset"] = features.T @ out, out.sum(0)
            back = (out @ params["dense"].T) * (features > 0)
            for i, w in enumerate(WIDTHS):
                (view, at), d = kept[i], back[:, i * FILTERS : (i + 1) * FILTERS]
                grads[f"bias{w}"] = d.sum(0)
                grads[f"filter{w}"] = np.einsum("nf,nfe->ef", d, view[np.arange(len(y))[:, None], at])
                pull = (d[:, :, None] * params[f"filter{w}"].T[None]).reshape(len(y), FILTERS, w, EMBEDDING)
                for k in range(w):
                    np.add.at(grads["embedding"], x[np.arange(len(y))[:, None], at + k], pull[:, :, k])
            step += 1
            for k, g in grads.items():
                m, v = moment[k]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                params[k] -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    shaped = tuple(params[f"filter{w}"].reshape(w, EMBEDDING, FILTERS) for w in WIDTHS)
    return Network(languages, params["embedding"], shaped, tuple(params[f"bias{w}"] for w in WIDTHS), params["dense"], params["offset"])


class Predictor:
    """A network folded into two tables by byte pairs: the answers' parts from bytes (0, 1) and from bytes (2, 3)."""

    def __init__(self, net: Network):
        self.net = net
        two, three, four = (np.einsum("be,kef->kbf", net.embedding, f) for f in net.filters)
        pair = lambda a, b: (a[:, None] + b[None]).reshape(65536, -1)
        nothing = np.zeros_like(three[2])
        self.near = np.concatenate([pair(t[0], t[1]) for t in (two, three, four)], 1).astype(np.float32)
        self.far = np.concatenate([pair(three[2], nothing), pair(four[2], four[3])], 1).astype(np.float32)
        self.bias = np.concatenate(net.biases)

    def windows(self, x: np.ndarray) -> np.ndarray:
        """Probabilities (n, languages) of windows (n, WINDOW)."""
        out = []
        for at in range(0, len(x), 64):
            w = x[at : at + 64].astype(np.uint16)
            pairs = (w[:, :-1] << 8) | w[:, 1:]
            answer = self.near[pairs[:, : WINDOW - 3]]
            answer[:, :, FILTERS:] += self.far[pairs[:, 2:]]
            out.append(answer.max(1))
        features = np.maximum(np.concatenate(out) + self.bias, 0)
        return _softmax(features @ self.net.dense + self.net.offset)

    def texts(self, texts: list[bytes]) -> np.ndarray:
        """Probabilities (n, languages) of whole texts."""
        total = np.zeros((len(texts), len(self.net.languages)))
        if texts:
            x, owner, size = windows_of(texts)
            for at in range(0, len(x), STEP):
                part = slice(at, at + STEP)
                np.add.at(total, owner[part], self.windows(x[part]) * size[part, None])
        return total / np.maximum(total.sum(1, keepdims=True), 1e-12)


_LOADED: dict[tuple, Predictor] = {}


def _predictor(net: Network) -> Predictor:
    """The folded network; a worker keeps the last one until its task ends."""
    key = net.key()
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Predictor(net)
    return _LOADED[key]


def _forget() -> None:
    """Free the folded network: a worker lives on for other stages, which have no use for it."""
    _LOADED.clear()
    give_back()


def remainder() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % 3


def sample(docs: DataFrame, per_language: int = SAMPLE_DOCS) -> list[tuple[str, list[bytes]]]:
    """About ``per_language`` labelled documents of each language, chosen by a hash of the id, some windows of each.

    All labelled documents are counted. The driver gets at most twice ``per_language`` documents of each language, which
    matters only where an id is repeated very often, and at most ``MOST_LANGUAGES`` languages. Only documents whose
    id's CRC-32 leaves a remainder other than 1 are read.
    """
    known = docs.where((remainder() != 1) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    langs = docs.where((remainder() != 1) & F.col("lang").isNotNull()).groupBy("lang").agg(F.count("*").alias("n"))
    counts = {r.lang: r.n for r in langs.orderBy(F.desc("n"), "lang").limit(MOST_LANGUAGES).collect()}
    if not counts:
        return []
    share = F.create_map(*[F.lit(v) for lang, n in sorted(counts.items()) for v in (lang, min(1.0, per_language / n))])
    draw = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 20)) / F.lit(1 << 20)
    place = lambda k: F.pmod(F.xxhash64("doc_id", F.lit(k)), F.greatest(F.length("text") - WINDOW + 1, F.lit(1))) + 1
    cut = F.array(*[F.substring("text", place(k), F.lit(WINDOW)) for k in range(SAMPLE_WINDOWS)])
    drawn = known.where(draw < share[F.col("lang")]).select("lang", "doc_id", cut.alias("cut"))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "cut"))
    rows = drawn.withColumn("nth", nth).where(F.col("nth") <= 2 * per_language).collect()
    return [(r.lang, [x.encode()[:WINDOW] for x in r.cut]) for r in sorted(rows, key=lambda r: (r.lang, r.doc_id, r.cut))]


def learn(docs: DataFrame, per_language: int = SAMPLE_DOCS) -> Network | None:
    rows = sample(docs, per_language)
    if not rows:
        return None
    languages = tuple(sorted({lang for lang, _ in rows}))
    texts = [w for _, cut in rows for w in cut]
    # some windows are shortened and some put in capitals, so that such texts are known too
    texts = [t if i % 3 else t[: 6 + (i * 37) % 200] for i, t in enumerate(texts)]
    texts = [t.decode("utf-8", "ignore").upper().encode()[:WINDOW] if i % 7 == 3 else t for i, t in enumerate(texts)]
    labels = np.array([languages.index(lang) for lang, cut in rows for _ in cut])
    return train(windows_of(texts)[0], labels, languages)


def predict(docs: DataFrame, net: Network | None, columns: list[str], text_too: bool = False) -> DataFrame:
    """The named columns of every row as a struct ``row``, the text if ``text_too``, lang_pred and score."""
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    read = docs.select(F.struct(*columns).alias("row"), "text", lettered.alias("lettered"))
    shown = ["row", *["text"] * text_too]
    if net is None:
        return read.select(*shown, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        model = _predictor(net)
        names = np.array([*net.languages, "und"], object)
        for batch in slices(batches, "text"):
            lettered = batch.column("lettered").to_numpy(zero_copy_only=False)
            texts = text_bytes(batch)
            told = model.texts([texts[i] for i in np.flatnonzero(lettered)])
            best, score = np.full(len(texts), len(net.languages)), np.zeros(len(texts))
            if len(told):
                best[lettered], score[lettered] = told.argmax(1), told.max(1)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in shown), pa.array(names[best], pa.string()), pa.array(score)], names=[*shown, "lang_pred", "score"])
        del model
        _forget()

    return read.mapInArrow(run, T.StructType([*(read.schema[c] for c in shown), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))


def keep_known(docs: DataFrame, least_score: float = 0.3) -> DataFrame:
    """``docs`` without the texts that have no language (``und``) or that no language scores ``least_score`` for."""
    told = predict(docs, learn(docs), [c for c in docs.columns if c != "text"], text_too=True)
    known = told.where((F.col("lang_pred") != "und") & (F.col("score") >= least_score))
    return known.select(*(F.col(c) if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    told = predict(docs, learn(docs), ["doc_id"]).select("row.doc_id", "lang_pred", "score")
    return told.select("doc_id", F.coalesce(remainder() == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")


QUERIES = {"op10_language_id": op10_language_id}
