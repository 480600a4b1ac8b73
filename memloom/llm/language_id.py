"""Language identification by a convolutional network over bytes.

Texts become bytes (A-Z as a-z, other ASCII signs as spaces), cut into windows
of fixed length.  Bytes are embedded, filters of widths 2, 3 and 4 slide over
each window, max pooling keeps each filter's best place, and softmax gives the
window's languages.  A document's languages are the mean over all its windows,
weighted by their letters.

Fitting is in numpy on a bounded sample: about rows_per_lang rows of each
language outside the held-out fold, fewer if all languages together would have
more than max_rows, by hash of doc_id, and windows_per_row windows of each.
Every language that a usable row names is learned.  The filters act on single
bytes and pairs, so applying them is a look-up in tables of pairs.

Defined cases: a text that is null or has no letter is "und" with score 0;
rows without language teach nothing, equal windows of one language teach once;
if no row teaches, texts are "und"; rows with one id are told one by one; an
empty table gives no rows; a very long text is all of its windows, some
hundred of which are in memory at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from memloom.llm.common import bounded_broadcast, fold, held_out, sliced, worker_held, written

UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")
#: Lower case for A-Z, spaces for other ASCII signs than letters.
PLAIN = bytes(b if b >= 128 or chr(b).islower() else ord(chr(b).lower()) if chr(b).isupper() else 32 for b in range(256))
WIDTHS = (2, 3, 4)


@dataclass(frozen=True)
class Options:
    """rows_per_lang, max_rows (of all languages) and windows_per_row bound what is fitted."""

    window: int = 256
    rows_per_lang: int = 500
    windows_per_row: int = 4
    max_rows: int = 40_000
    dim: int = 8
    filters: int = 12
    epochs: int = 8
    batch: int = 64
    rate: float = 0.004
    seed: int = 11


def windows(text: str | None, size: int) -> np.ndarray:
    """The whole text as rows of size + 3 bytes: the windows and the bytes that their last filters reach into."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(PLAIN)
    data = np.frombuffer(data, dtype=np.uint8)
    rows = max(1, -(-len(data) // size))
    flat = np.full(rows * size + 3, 32, dtype=np.uint8)
    flat[: len(data)] = data
    return np.lib.stride_tricks.as_strided(flat, (rows, size + 3), (size, 1)).copy()


class ByteNet:
    """Embedding, filters of three widths, ReLU, max pooling, softmax."""

    def __init__(self, languages: list[str], o: Options):
        rng = np.random.default_rng(o.seed)
        self.languages, self.o = languages, o
        self.w = {"e": rng.normal(0, 0.5, (256, o.dim))}
        for k in WIDTHS:
            self.w[f"f{k}"] = rng.normal(0, (1 / (k * o.dim)) ** 0.5, (k * o.dim, o.filters))
            self.w[f"b{k}"] = np.zeros(o.filters)
        self.w["s"] = rng.normal(0, 0.1, (len(WIDTHS) * o.filters, len(languages)))
        self.w["t"] = np.zeros(len(languages))
        self.w = {k: v.astype(np.float32) for k, v in self.w.items()}

    def gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        w, size, rows = self.w, self.o.window, np.arange(len(x))
        e = w["e"][x]
        pooled, places = [], []
        for k in WIDTHS:
            full = sum(e[:, j : j + size] @ w[f"f{k}"].reshape(k, self.o.dim, -1)[j] for j in range(k)) + w[f"b{k}"]
            places.append(full.argmax(1))
            pooled.append(full.max(1))
        h = np.concatenate(pooled, 1)
        a = np.maximum(h, 0)
        z = a @ w["s"] + w["t"]
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        p[rows, y] -= 1
        p /= len(x)
        out = {"s": a.T @ p, "t": p.sum(0), "e": np.zeros_like(w["e"])}
        dh = (p @ w["s"].T) * (h > 0)
        for i, k in enumerate(WIDTHS):
            d = dh[:, i * self.o.filters : (i + 1) * self.o.filters]
            at = places[i][:, :, None] + np.arange(k)
            seen = e[rows[:, None, None], at].reshape(len(x), self.o.filters, -1)
            out[f"f{k}"] = np.einsum("nf,nfc->cf", d, seen)
            out[f"b{k}"] = d.sum(0)
            back = (d[:, :, None] * w[f"f{k}"].T[None]).reshape(-1, self.o.dim)
            np.add.at(out["e"], x[rows[:, None, None], at].reshape(-1), back)
        return out

    def train(self, x: np.ndarray, y: np.ndarray) -> None:
        """Adam over shuffled batches."""
        rng = np.random.default_rng(self.o.seed)
        m = {k: np.zeros_like(v) for k, v in self.w.items()}
        v2 = {k: np.zeros_like(v) for k, v in self.w.items()}
        step = 0
        for _ in range(self.o.epochs):
            order = rng.permutation(len(x))
            for at in range(0, len(x), self.o.batch):
                step += 1
                for k, g in self.gradients(x[order[at : at + self.o.batch]], y[order[at : at + self.o.batch]]).items():
                    m[k] += 0.1 * (g - m[k])
                    v2[k] += 0.001 * (g * g - v2[k])
                    self.w[k] -= (self.o.rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v2[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)

    def tables(self) -> dict[str, np.ndarray]:
        """Filters as sums over single bytes and pairs of bytes."""
        w, d = self.w, self.o.dim
        one = {(k, j): w["e"] @ w[f"f{k}"].reshape(k, d, -1)[j] for k in WIDTHS for j in range(k)}
        pair = lambda k, j: (one[k, j][:, None] + one[k, j + 1][None]).reshape(65536, -1)
        return {"pair": np.ascontiguousarray(np.concatenate([pair(2, 0), pair(3, 0), pair(4, 0)], 1)), "third": one[3, 2], "tail": np.ascontiguousarray(pair(4, 2))}

    def predict(self, x: np.ndarray, t: dict[str, np.ndarray]) -> np.ndarray:
        w, f, size = self.w, self.o.filters, self.o.window
        at = (x[:, :-1].astype(np.int32) << 8) | x[:, 1:]
        base = t["pair"].take(at[:, :size].ravel(), axis=0).reshape(len(x), size, 3 * f)
        base[:, :, f : 2 * f] += t["third"].take(x[:, 2 : size + 2].ravel(), axis=0).reshape(len(x), size, f)
        base[:, :, 2 * f :] += t["tail"].take(at[:, 2 : size + 2].ravel(), axis=0).reshape(len(x), size, f)
        h = np.maximum(base.max(1) + np.concatenate([w[f"b{k}"] for k in WIDTHS]), 0)
        z = h @ w["s"] + w["t"]
        p = np.exp(z - z.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)


def fit(docs: DataFrame, options: Options = Options()) -> ByteNet | None:
    """The network, from text and language of rows outside the held-out fold; None if none has a language."""
    o = options
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.coalesce(fold(F.col("doc_id")) != 1, F.lit(False)))
    counts = written(usable.groupBy("lang").count(), "languages")
    languages = counts.count()
    if not languages:
        return None
    rows = max(1, min(o.rows_per_lang, o.max_rows // languages))
    counts = bounded_broadcast(counts.select(F.col("lang").alias("own_lang"), (rows / F.col("count")).alias("part")), 64)
    usable = usable.select("doc_id", "lang", "text").join(counts, F.col("lang") == F.col("own_lang"))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            langs, data = [], []
            for doc_id, lang, text in zip(*(c.to_pylist() for c in batch.columns)):
                if LETTER.search(text):
                    own = windows(text, o.window)
                    for k in np.random.default_rng(doc_id % 2**32).permutation(len(own))[: o.windows_per_row]:
                        langs.append(lang)
                        data.append(own[k].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(data, pa.binary())], names=["lang", "data"])

    chosen = usable.where(place < F.col("part")).select(F.col("doc_id").cast("long"), "lang", "text")
    # About half as many windows as the limit are expected; it holds if ids are few.
    most = 2 * o.windows_per_row * rows * languages + 1000
    found = chosen.mapInArrow(cut, "lang string, data binary").distinct()
    table = found.orderBy(F.xxhash64("lang", "data"), "lang", "data").limit(most).toArrow()
    rows = sorted(zip(table["lang"].to_pylist(), table["data"].to_pylist()))
    if not rows:
        return None
    net = ByteNet(sorted({r[0] for r in rows}), o)
    x = np.frombuffer(b"".join(r[1] for r in rows), dtype=np.uint8).reshape(len(rows), -1)
    net.train(x, np.searchsorted(net.languages, [r[0] for r in rows]))
    return net


def identify(docs: DataFrame, net: ByteNet | None, chunk: int = 256, lang_pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """docs with lang_pred and score, under names that docs must not have yet (see free_name)."""
    if taken := {lang_pred.lower(), score.lower()} & {c.lower() for c in docs.columns}:
        raise ValueError(f"documents have columns {sorted(taken)} of their own")
    names, at = docs.columns, docs.columns.index("text")
    schema = T.StructType([*docs.schema.fields, T.StructField(lang_pred, T.StringType()), T.StructField(score, T.DoubleType())])
    sent = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        # Made by each task, since models differ; what other operators keep goes.
        t = worker_held("languages", dict)[0] = own.tables() if own else None
        for batch in sliced(batches):
            texts = batch.column(at).to_pylist()
            known = [k for k, x in enumerate(texts) if own is not None and x and LETTER.search(x)]
            total = np.zeros((len(texts), len(own.languages) if own else 1))
            held: list[np.ndarray] = []
            row_of: list[int] = []

            def flush() -> None:
                x = np.concatenate(held)
                p = own.predict(x, t) * (1e-3 + (x[:, : own.o.window] != 32).sum(1))[:, None]
                np.add.at(total, row_of, p)
                held.clear()
                row_of.clear()

            for k in known:
                found = windows(texts[k], own.o.window)
                for a in range(0, len(found), chunk):
                    held.append(found[a : a + chunk])
                    row_of += [k] * len(held[-1])
                    if len(row_of) >= chunk:
                        flush()
            if held:
                flush()
            lang, share = [UNKNOWN] * len(texts), np.zeros(len(texts))
            for k in known:
                best = int(total[k].argmax())
                lang[k], share[k] = own.languages[best], total[k, best] / total[k].sum()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lang, pa.string()), pa.array(share)], names=[*names, lang_pred, score])

    return docs.mapInArrow(run, schema)


def language_report(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score."""
    told = identify(docs.select("doc_id", "text"), fit(docs))
    return told.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
