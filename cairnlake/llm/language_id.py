"""Operator 9. Language of texts from a small byte convolutional network, trained here in numpy.

Bytes are embedded; filters of several widths slide over a window of WINDOW bytes; each filter's
maximum is pooled; a softmax over the learned languages follows. The driver trains on a bounded sample
(PER_LANG labelled rows of each language, a random stretch of STRETCH characters of each) and
broadcasts the net, a few thousand numbers. Texts are then read whole: all their windows are scored and
averaged by their bytes. Scoring is one pass without a shuffle; embedding and filters are fused into
one table for each place of each filter, and those of two neighbouring places into one for pairs of
bytes, so a byte costs five look-ups.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cairnlake.llm import packed as P
from cairnlake.llm.shared import others, unused

WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 8
EMBEDDED = 8
PER_LANG = 400
AMPLE = 4
STRETCH = 2048
EPOCHS = 12
BATCH = 64
RATE = 0.01
CHUNK = 256 << 10
#: Windows scored together: their look-ups stay in a core's cache.
SCORED = 512
UNKNOWN = "und"


class ByteNet:
    """Embedding (256, e), filters (width, e, f) and a bias for each width, softmax (f * widths, classes)."""

    def __init__(self, langs: list[str], seed: int = 5):
        rng = np.random.default_rng(seed)
        self.langs = langs
        self.p = {"embed": rng.normal(0, 0.5, (256, EMBEDDED))}
        for w in WIDTHS:
            self.p[f"filter{w}"] = rng.normal(0, 1 / np.sqrt(w * EMBEDDED), (w, EMBEDDED, FILTERS))
            self.p[f"bias{w}"] = np.zeros(FILTERS)
        self.p["out"] = rng.normal(0, 0.1, (FILTERS * len(WIDTHS), len(langs)))
        self.p["out_bias"] = np.zeros(len(langs))

    def train(self, windows: np.ndarray, label: np.ndarray) -> None:
        """Adam over mini-batches of windows (n, WINDOW) with their languages' numbers."""
        rng = np.random.default_rng(11)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        for epoch in range(EPOCHS):
            rate = RATE * (1 - epoch / EPOCHS)
            order = rng.permutation(len(windows))
            for lo in range(0, len(order), BATCH):
                own = order[lo : lo + BATCH]
                step += 1
                for k, g in self._gradients(windows[own], label[own]).items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    s[k] = 0.999 * s[k] + 0.001 * g * g
                    self.p[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.999**step)) + 1e-8)

    def _gradients(self, x: np.ndarray, label: np.ndarray) -> dict:
        p, n = self.p, len(x)
        e = p["embed"][x]
        pooled, where = [], []
        for w in WIDTHS:
            span = WINDOW - w + 1
            r = sum(e[:, j : j + span] @ p[f"filter{w}"][j] for j in range(w)) + p[f"bias{w}"]
            best = r.argmax(1)
            where.append(best)
            pooled.append(np.take_along_axis(r, best[:, None], 1)[:, 0])
        h = np.concatenate(pooled, 1)
        live = h > 0
        a = np.where(live, h, 0)
        score = _softmax(a @ p["out"] + p["out_bias"])
        score[np.arange(n), label] -= 1
        score /= n
        g = {"out": a.T @ score, "out_bias": score.sum(0), "embed": np.zeros_like(p["embed"])}
        back = (score @ p["out"].T) * live
        rows = np.arange(n)[:, None]
        for i, w in enumerate(WIDTHS):
            b = back[:, i * FILTERS : (i + 1) * FILTERS]
            g[f"bias{w}"] = b.sum(0)
            f = p[f"filter{w}"]
            gf = np.empty_like(f)
            for j in range(w):
                at = where[i] + j
                gf[j] = np.einsum("nfe,nf->ef", e[rows, at], b)
                np.add.at(g["embed"], x[rows, at], b[:, :, None] * f[j].T[None])
            g[f"filter{w}"] = gf
        return g

    def fused(self) -> tuple[list[list[np.ndarray]], list[np.ndarray], np.ndarray, np.ndarray]:
        """For each width and place a table (256, FILTERS); biases; the softmax. `paired` is for scoring."""
        tables = [
            [np.ascontiguousarray((self.p["embed"] @ self.p[f"filter{w}"][j]).astype(np.float32)) for j in range(w)]
            for w in WIDTHS
        ]
        bias = [self.p[f"bias{w}"].astype(np.float32) for w in WIDTHS]
        return tables, bias, self.p["out"].astype(np.float32), self.p["out_bias"].astype(np.float32)


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(1, keepdims=True))
    return z / z.sum(1, keepdims=True)


def paired(net):
    """A fused net with one table for each two neighbouring places of a filter, (256 * 256, FILTERS)."""
    tables, *rest = net
    pairs = [
        [
            (places[j][:, None] + places[j + 1][None]).reshape(1 << 16, -1) if j + 1 < len(places) else places[j]
            for j in range(0, len(places), 2)
        ]
        for places in tables
    ]
    return pairs, *rest


def window_scores(windows: np.ndarray, net) -> np.ndarray:
    """Each language's probability for each window (n, WINDOW) of bytes; `net` as `paired` has it."""
    pairs, bias, out, out_bias = net
    one = windows.astype(np.intp)
    two = one[:, :-1] << 8 | one[:, 1:]
    pooled = []
    for w, tables, b in zip(WIDTHS, pairs, bias, strict=True):
        span = WINDOW - w + 1
        r = None
        for j, table in zip(range(0, w, 2), tables, strict=True):
            at = two if j + 1 < w else one
            own = np.take(table, at[:, j : j + span], axis=0, mode="clip")
            r = own if r is None else np.add(r, own, out=r)
        pooled.append(r.max(1) + b)
    return _softmax(np.maximum(np.concatenate(pooled, 1), 0) @ out + out_bias)


def cut(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of all rows, the last one of a row filled up with zeros; their rows and bytes."""
    size = np.diff(bounds)
    many = -(-size // WINDOW)
    row = np.repeat(np.arange(len(size)), many)
    place = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
    begin = bounds[:-1][row] + place * WINDOW
    length = np.minimum(WINDOW, bounds[1:][row] - begin)
    at = begin[:, None] + np.arange(WINDOW)
    windows = np.where(np.arange(WINDOW) < length[:, None], data[np.minimum(at, len(data) - 1)], 0)
    return windows.astype(np.uint8), row, length


def text_scores(column, net) -> np.ndarray:
    """Each language's share for each text: its windows' probabilities, weighed by their bytes; `net` is a fused one."""
    net = paired(net)
    classes = len(net[3])
    found = np.zeros((len(column), classes))
    for lo, data, bounds in P.chunks(column, CHUNK):
        if not len(data):
            continue
        step = SCORED
        windows, row, length = cut(data, bounds)
        for i in range(0, len(row), step):
            score = window_scores(windows[i : i + step], net).astype(np.float64) * length[i : i + step, None]
            own = row[i : i + step]
            first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            found[lo + own[first]] += np.add.reduceat(score, first)
    total = found.sum(1, keepdims=True)
    return np.divide(found, total, out=np.zeros_like(found), where=total > 0)


def trained(
    labelled: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", per_lang: int = PER_LANG
) -> ByteNet | None:
    """A net for the languages of `labelled`, from at most `per_lang` rows of each; None without any.

    The rows are those with the smallest hash of key and text. Rows whose hash is far too large, by
    the number of rows of their language, are left out before the shuffle, so that about AMPLE times
    as many rows as needed arrive, however many there are. Languages are the net's classes, a few.
    """
    rows = labelled.where(F.col(text).isNotNull() & F.col(lang).isNotNull() & (F.length(text) > 0))
    h = F.xxhash64(F.col(key), F.col(text))
    begin = F.pmod(h, F.greatest(F.lit(1), F.length(text) - STRETCH)).cast("int") + 1
    rows = rows.select(F.col(lang).alias("lang"), h.alias("h"), F.substring(F.col(text), begin, F.lit(STRETCH)).alias("text"))
    many = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    bound = [x for v, n in many.items() for x in (F.lit(v), F.lit(min(1.0, AMPLE * per_lang / n)))]
    if not bound:
        return None
    spread = F.col("h").cast("double") / F.lit(float(1 << 64)) + 0.5  # from 0 to 1
    rows = rows.where(spread <= F.create_map(*bound)[F.col("lang")])
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h", "text"))
    sample = rows.withColumn("place", place).where(F.col("place") <= per_lang).orderBy("lang", "place").collect()
    langs = sorted({r.lang for r in sample})
    texts = [r.text.encode() for r in sample]
    bounds = np.r_[0, np.cumsum([len(t) for t in texts])]
    windows, row, length = cut(np.frombuffer(b"".join(texts), np.uint8), bounds)
    label = np.array([langs.index(r.lang) for r in sample])[row]
    net = ByteNet(langs)
    net.train(windows, label)
    return net


def predicted_languages(
    docs: DataFrame, net: ByteNet | None, text: str = "text", lang: str = "lang_pred", score: str = "score"
) -> DataFrame:
    """`docs` with the columns `lang` and `score` put last (columns of these names are replaced).

    A null or empty text, or one without a letter, has the language `und` and score 0; so has every
    text if no net could be trained. Ties go to the first language in alphabetical order. Other
    columns stay as they are; an empty table stays empty.
    """
    other = others(docs.columns, lang, score)
    readable = F.col(text).isNotNull() & F.col(text).rlike(r"\p{L}")
    if net is None:
        return docs.select(*other, F.lit(UNKNOWN).alias(lang), F.lit(0.0).alias(score))
    held = docs.sparkSession.sparkContext.broadcast((net.langs, net.fused()))

    def judge(texts):
        langs, net = held.value
        found = text_scores(texts, net)
        best = found.argmax(1)
        return pa.StructArray.from_arrays(
            [pa.array(langs, pa.string()).take(pa.array(best)), pa.array(found.max(1).round(6))], ["lang", "score"]
        )

    judge = F.arrow_udf(judge, "lang string, score double")
    judged, known = unused(docs.columns, "judged"), unused(docs.columns, "readable")
    rows = docs.select(*other, judge(F.col(text)).alias(judged), readable.alias(known))
    return rows.select(
        *other,
        F.when(F.col(known), F.col(f"{judged}.lang")).otherwise(UNKNOWN).alias(lang),
        F.when(F.col(known), F.col(f"{judged}.score")).otherwise(0.0).alias(score),
    )


def held_out(key: str = "doc_id"):
    """A quarter of all rows, by key, that nothing is learned from."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % 4 == 2


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    net = trained(docs.where(~held_out()))
    rows = docs.select("doc_id", "text", held_out().alias("held_out"))
    return predicted_languages(rows, net).select("doc_id", "held_out", "lang_pred", "score")
