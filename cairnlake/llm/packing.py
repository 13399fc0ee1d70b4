"""Operator 11. Documents concatenated and cut into sequences of a fixed number of tokens.

Pass one encodes every text and writes the ids, each row with the tokens that its partition holds
before it. Prefix sums over the partitions' totals (`prefix_sums`) tell where each partition begins in
the one endless stream. Pass two cuts every row where the stream passes a multiple of the window; a
piece knows its sequence and its place there, and a row that crosses a border leaves a piece on either
side. Only the end of the stream can fall short of a window. Nothing is shuffled but the totals, unless
those are too many for Spark to broadcast; then rows meet them by partition.

The library encodes each different word of a partition once: white space never gets into a token of
these vocabularies, so a text's ids are those of its words, cut at spaces, one after the other.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnlake.llm.prefix_sums import sums_before
from cairnlake.llm.shared import written
from cairnlake.llm.token_counts import byte_characters

WINDOW = 2048
END_ID = 1
#: A text is taken to words in stretches of about so many characters; about so many words are
#: remembered by a task.
STRETCH = 1 << 20
REMEMBERED = 800_000
#: The character by which a byte-level vocabulary shows each byte.
SHOWN = dict(enumerate(byte_characters()))


class WordIds(dict):
    """Ids of texts by a word-wise vocabulary, as bytes: little-endian unsigned, of `kind`.

    Holds the words met so far. Words of printable ASCII and composed Latin letters (which the vocabulary's
    normal form leaves as they are) are lower-cased and split here, so that one that differs in case or
    punctuation costs nothing new, and their parts given to the library's model; all others, and those
    with a special string, go through the library whole.
    """

    def __init__(self, spec: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import regex
        from tokenizers import Tokenizer

        pattern = require_word_wise(spec)
        self.library = Tokenizer.from_str(spec)
        self.model = self.library.model
        self.kind = np.dtype(id_type(self.library.get_vocab_size(with_added_tokens=True)))
        self.parts = regex.compile(pattern).findall
        special = "".join(f"(?!.*{regex.escape(x['content'])})" for x in json.loads(spec)["added_tokens"])
        self.plain = regex.compile(special + r"[\t\n\r -~À-ÖØ-öø-įĲ-ſ]*", regex.DOTALL).fullmatch

    def ids(self, text: str) -> bytes:
        return b"".join(self._stretch(piece) for piece in stretches(text))

    def _stretch(self, piece: str) -> bytes:
        if len(self) > REMEMBERED:
            self.clear()
        return b"".join(map(self.__getitem__, piece.split(" ")))

    def __missing__(self, word: str) -> bytes:
        low = word.lower()
        if word.isascii() and word.isalpha():
            parts = [low]
        elif self.plain(word):
            parts = self.parts(low)
        else:
            parts = None
        if parts is None:
            found = np.array(self.library.encode(word, add_special_tokens=False).ids, self.kind).tobytes()
        elif parts == [word]:
            shown = word if word.isascii() else word.encode().decode("latin-1").translate(SHOWN)
            found = np.array([t.id for t in self.model.tokenize(shown)], self.kind).tobytes()
        else:
            found = b"".join(map(self.__getitem__, parts))
        self[word] = found
        return found


def require_word_wise(spec: str) -> str:
    """The pattern of a text's parts; ValueError unless words between spaces are encoded on their own."""
    given = json.loads(spec)
    steps = [given.get("normalizer"), given.get("pre_tokenizer")]
    steps = [s.get("normalizers") or s.get("pretokenizers") or [s] if s else [] for s in steps]
    normal, split = [[s["type"] for s in step] for step in steps]
    first = steps[1][0] if steps[1] else {}
    plain = set(normal) <= {"NFC", "Replace", "Lowercase"} and split == ["Split", "ByteLevel"]
    dropped = first.get("behavior") == "Removed" and first.get("invert")
    widened = any(x["lstrip"] or x["rstrip"] or x["single_word"] or " " in x["content"] for x in given["added_tokens"])
    cut = given.get("truncation") or given.get("padding")
    if not (plain and dropped and given["model"].get("end_of_word_suffix")) or widened or cut:
        raise ValueError("not a vocabulary that drops white space and encodes words one by one")
    return first["pattern"]["Regex"]


def id_type(size: int) -> str:
    return "<u2" if size <= 1 << 16 else "<u4"


def stretches(text: str) -> Iterator[str]:
    """The text, cut at spaces (which are left out) into stretches of at least STRETCH characters."""
    at = 0
    while len(text) - at > STRETCH and (space := text.find(" ", at + STRETCH)) >= 0:
        yield text[at:space]
        at = space + 1
    yield text[at:]


def encoded(docs: DataFrame, vocabulary: str, key: str, text: str, end_id: int) -> tuple[DataFrame, str]:
    """Rows (part, before, key, n, ids) written to the shared folder, and the type of an id in `ids`.

    part: the partition that encoded the row; before: the tokens of its earlier rows.
    """
    from tokenizers import Tokenizer

    with open(vocabulary, encoding="utf-8") as f:
        spec = f.read()
    require_word_wise(spec)
    size = Tokenizer.from_str(spec).get_vocab_size(with_added_tokens=True)
    if not 0 <= end_id < size:
        raise ValueError(f"the end id {end_id} is not one of the vocabulary's {size}")
    shared = docs.sparkSession.sparkContext.broadcast(spec)
    number = docs.schema[key].dataType.simpleString()
    kind = id_type(size)

    def rows(batches):
        coder, before = WordIds(shared.value), 0
        end = np.array([end_id], coder.kind).tobytes()
        for batch in batches:
            ids = [coder.ids(t.as_py() or "") + end for t in batch.column("text")]
            n = np.fromiter(map(len, ids), np.int64, len(ids)) // coder.kind.itemsize
            yield pa.RecordBatch.from_arrays(
                [batch.column("part"), pa.array(before + np.cumsum(n) - n), batch.column("key"), pa.array(n), pa.array(ids, pa.binary())],
                ["part", "before", "key", "n", "ids"],
            )
            before += int(n.sum())

    table = docs.select(F.spark_partition_id().cast("long").alias("part"), F.col(key).alias("key"), F.col(text).alias("text"))
    return written(table.mapInArrow(rows, f"part long, before long, key {number}, n long, ids binary"), "encoded"), kind


def packed_pieces(
    docs: DataFrame,
    vocabulary: str,
    key: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    end_id: int = END_ID,
) -> DataFrame:
    """Pieces (key, start, length, doc_tokens, sequence_id, offset, ids) of all rows of `docs`.

    `vocabulary` is the path, on the driver, of a word-wise vocabulary (.json) of the tokenizers library.
    A row's ids are the library's, without special tokens added (special strings inside texts become
    their ids, as the library does), then `end_id`. Null or empty text has `end_id` alone. Every id lies
    in one piece; pieces of a sequence follow each other from offset 0 without a gap; all sequences but
    the last are full. `ids` are the piece's as little-endian unsigned 32-bit numbers, `doc_tokens` the
    row's number of ids. Which row follows which is the order of the table's partitions. Rows that
    repeat, or bear the same key or none, are packed each. Columns other than key and text are not read.
    An empty table gives an empty table.
    """
    rows, kind = encoded(docs, vocabulary, key, text, end_id)
    totals = rows.groupBy("part").agg(F.max(F.col("before") + F.col("n")).alias("total"))
    begins = written(sums_before(totals, "part", "total"), "begins").withColumnRenamed("before", "begin")
    placed = rows.join(begins, "part").select("key", "n", (F.col("begin") + F.col("before")).alias("place"), "ids")
    number = docs.schema[key].dataType.simpleString()

    def cut(batches):
        for batch in batches:
            n, place = (batch.column(c).to_numpy() for c in ("n", "place"))
            first, last = place // window, (place + n - 1) // window
            per = last - first + 1
            row = np.repeat(np.arange(len(n)), per)
            sequence = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per) + first[row]
            start = np.maximum(sequence * window - place[row], 0)
            length = np.minimum((sequence + 1) * window - place[row], n[row]) - start
            # the rows' ids lie end to end, and so do the pieces'
            narrow = batch.column("ids")
            offsets = np.frombuffer(narrow.buffers()[1], np.int32)[narrow.offset : narrow.offset + len(narrow) + 1]
            data = np.frombuffer(narrow.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]] if len(n) else b""
            wide = np.frombuffer(data, kind).astype("<u4")
            ends = np.r_[0, np.cumsum(length) * 4]
            if ends[-1] >= 1 << 31:
                raise ValueError("more than 2 GB of ids in one batch: lower spark.sql.execution.arrow.maxRecordsPerBatch")
            ids = pa.Array.from_buffers(
                pa.binary(), len(row), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(wide)]
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key").take(pa.array(row)),
                    *(pa.array(x.astype(np.int64)) for x in (start, length, n[row], sequence, place[row] + start - sequence * window)),
                    ids,
                ],
                ["key", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
            )

    schema = f"key {number}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
    return placed.mapInArrow(cut, schema).withColumnRenamed("key", key)


def sequences(pieces: DataFrame, key: str = "doc_id", window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """(sequence_id, n_tokens, ids, boundaries) of the pieces of `packed_pieces`, each padded to `window`.

    ids: the sequence's ids as little-endian unsigned 32-bit numbers, filled up with `pad_id`; n_tokens:
    how many are no padding; boundaries: one record (offset, length, key, start, doc_tokens) for each piece,
    in order, so that attention can be cut and documents put together again. A sequence has at most
    `window` pieces.
    """
    record = F.struct("offset", "length", F.col(key), "start", "doc_tokens", "ids")
    rows = pieces.groupBy("sequence_id").agg(F.array_sort(F.collect_list(record)).alias("r"), F.sum("length").alias("n_tokens"))
    pad = F.lit(np.array([pad_id], "<u4").tobytes())
    joined = F.aggregate("r", F.lit(b""), lambda done, x: F.concat(done, x["ids"]))
    names = ["offset", "length", key, "start", "doc_tokens"]
    return rows.select(
        "sequence_id",
        "n_tokens",
        F.concat(joined, F.unhex(F.repeat(F.hex(pad), (window - F.col("n_tokens")).cast("int")))).alias("ids"),
        F.transform("r", lambda x: F.struct(*(x[c].alias(c) for c in names))).alias("boundaries"),
    )


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    pieces = packed_pieces(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
