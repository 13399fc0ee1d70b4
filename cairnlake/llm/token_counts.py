"""Operator 8. Tokens of a byte-level pair-merging tokenizer, counted without its library.

Texts are split at special strings and then into pre-tokens. The pre-tokens that a batch has not met
yet are held as ragged numpy arrays: symbols end to end, and the sequence each belongs to. In every
round each sequence finds its lowest-rank pair and merges all its occurrences, all sequences at once;
what survives is the count. One pass over the texts, no shuffle; the vocabulary is a bounded file that
the driver reads and broadcasts.
"""

from __future__ import annotations

import json
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed value: the byte-level pre-tokenizer's pattern.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LIMIT = 1024
#: Texts of more characters are split piecemeal; so many pre-tokens are counted together, and
#: so many different ones remembered by a task.
LONG_TEXT = 1 << 20
GROUP = 1 << 18
REMEMBERED = 300_000
NONE = np.iinfo(np.int32).max


class Merges:
    """A vocabulary's merges as sorted arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        kinds = (spec["model"]["type"], (spec.get("pre_tokenizer") or {}).get("type"), spec.get("normalizer"))
        if kinds != ("BPE", "ByteLevel", None) or spec["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError(f"{path} is no plain byte-level vocabulary")
        if spec["model"].get("ignore_merges"):
            raise ValueError("vocabularies that take whole words as they are found are not supported")
        ids = spec["model"]["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        a = np.array([ids[x] for x, _ in pairs], np.int64)
        b = np.array([ids[y] for _, y in pairs], np.int64)
        made = np.array([ids[x + y] for x, y in pairs], np.int32)
        pair = a << 32 | b
        order = np.argsort(pair, kind="stable")
        self.pair, self.rank, self.made = pair[order], order.astype(np.int32), made[order]
        self.byte = np.array([ids[c] for c in byte_characters()], np.int32)
        self.special = [x["content"] for x in spec["added_tokens"]]
        if any(x[k] for x in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError("special strings that take their surroundings along are not supported")


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself if it shows, else the next one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


def merged_counts(pretokens: list[str], merges: Merges) -> np.ndarray:
    """The symbols that survive in each pre-token."""
    if not pretokens:
        return np.zeros(0, np.int64)
    encoded = [p.encode("utf-8", "replace") for p in pretokens]
    sizes = np.fromiter(map(len, encoded), np.int64, len(encoded))
    symbols = merges.byte[np.frombuffer(b"".join(encoded), np.uint8)]
    owner = np.repeat(np.arange(len(encoded)), sizes)
    counts = sizes.copy()
    while len(symbols) > 1:
        pair = symbols[:-1].astype(np.int64) << 32 | symbols[1:]
        at = np.minimum(np.searchsorted(merges.pair, pair), len(merges.pair) - 1)
        rank = np.where((merges.pair[at] == pair) & (owner[:-1] == owner[1:]), merges.rank[at], NONE)
        rank = np.append(rank, NONE)
        first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        least = np.minimum.reduceat(rank, first)
        per = np.diff(np.r_[first, len(owner)])
        hit = (rank == np.repeat(least, per)) & (rank != NONE)
        places = np.flatnonzero(hit)
        if not len(places):
            break
        # of pairs that overlap, as in aaa, the first, third, ... merge
        run = np.r_[0, np.cumsum(np.diff(places) != 1)]
        begin = places[np.r_[True, np.diff(run) > 0]]
        places = places[(places - begin[run]) % 2 == 0]
        symbols[places] = merges.made[at[places]]
        counts -= np.bincount(owner[places], minlength=len(counts))
        stay = np.ones(len(symbols), bool)
        stay[places + 1] = False
        stay &= np.repeat(least != NONE, per)  # sequences without a pair are done
        symbols, owner = symbols[stay], owner[stay]
    return counts


def _pieces(text: str, pattern):
    if len(text) <= LONG_TEXT:
        yield pattern.findall(text)
        return
    found = pattern.finditer(text)
    while piece := [m.group() for m in islice(found, 1 << 17)]:
        yield piece


def count_tokens(
    docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", limit: int = LIMIT
) -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) for each row of `docs`.

    `vocabulary` is the path, on the driver, of a byte-level pair-merging vocabulary (.json). Special
    strings inside texts are one token each; none is added at begin or end, nothing is cut or padded.
    Null or empty text: 0 bytes, 0 tokens. Rows that repeat are counted each. Columns other than key
    and text are not read. An empty table gives an empty table.
    """
    merges = docs.sparkSession.sparkContext.broadcast(Merges(vocabulary))
    rows = docs.select(
        F.col(key).alias("key"),
        F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long").alias("n_bytes"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    kind = docs.schema[key].dataType.simpleString()

    def counted(batches):
        import regex

        table, pattern = merges.value, regex.compile(PATTERN)
        special = regex.compile("|".join(map(regex.escape, table.special))) if table.special else None
        known: dict[str, int] = {}
        for batch in batches:
            totals = [0] * len(batch)
            held, size = [], 0

            def settle():
                """Count the pre-tokens at hand; those not met before are merged together."""
                if len(known) > REMEMBERED:
                    known.clear()
                fresh = {p for _, piece in held for p in piece if p not in known}
                fresh = sorted(fresh)
                known.update(zip(fresh, merged_counts(fresh, table).tolist(), strict=True))
                for row, piece in held:
                    totals[row] += sum(map(known.__getitem__, piece))
                held.clear()

            for row, whole in enumerate(batch.column("text").to_pylist()):
                segments = special.split(whole) if special and special.search(whole) else [whole]
                totals[row] = len(segments) - 1
                for segment in segments:
                    for piece in _pieces(segment, pattern):
                        held.append((row, piece))
                        size += len(piece)
                        if size >= GROUP:
                            settle()
                            size = 0
            settle()
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("n_bytes"), pa.array(totals, pa.int64())],
                ["key", "n_bytes", "n_tokens"],
            )

    return rows.mapInArrow(counted, f"key {kind}, n_bytes long, n_tokens long").select(
        F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))
