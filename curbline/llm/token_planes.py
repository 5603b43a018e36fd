"""Token ids on storage: fixed-size blocks of ids, transposed to byte or bit planes and compressed."""

from __future__ import annotations

import re
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from curbline.llm.common import one_per_id
from curbline.session import arrow_batches, materialise, shared_dir

BLOCK_IDS = 65_536
# Rows of text a shard aims at. A shard is one task's sorted stretch of doc_ids.
SHARD_BYTES = 64 << 20
# Rows and bytes of texts, and of blocks, that a task gets at once.
BATCH = (1_000, "4m")
BLOCK_BATCH = (4, "4m")
# Bytes of a file's row group, which a reader holds whole: a few blocks.
GROUP_BYTES = 8 << 20
# Words whose ids a task remembers: twice so many, of at most so many bytes.
REMEMBERED = 200_000
REMEMBERED_BYTES = 64
# Bytes of text that are cut into words together; their new words are encoded in one call.
TOGETHER = 2 << 20
MARK = "\x1f"
# Bytes in lower case, and what they are: a letter 1, a mark beside which the tokenizer always cuts 2, anything else 0.
LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)
KIND = np.array([1 if chr(c).isalpha() and c < 128 else 2 * (chr(c) in '.,;:!?#$%&*()"-') for c in range(256)], np.uint8)
# The tokenizer's cut of a lower-cased word, for the characters that PLAIN admits.
PLAIN = re.compile("[!-~\u00c0-\u00ff]+")
PIECE = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z\u00df-\u00f6\u00f8-\u00ff0-9]+")

BLOCKS = ("shard int, block int, first_id long, n_ids int, width int, planes array<binary>, "
          "docs array<struct<seq: int, doc_id: long, start: int, n: int, whole: boolean>>")


def to_planes(ids: np.ndarray, unit: str = "byte") -> tuple[int, list[bytes]]:
    """A block of ids as compressed planes: plane k holds byte (or bit) k of every id.

    Returns the bytes per id used before transposing and the planes, lowest first.
    """
    width = max(1, (int(ids.max()).bit_length() + 7) // 8) if len(ids) else 1
    rows = ids.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width]
    if unit == "bit":
        bits = np.unpackbits(rows, axis=1, bitorder="little")
        planes = [np.packbits(bits[:, k], bitorder="little").tobytes() for k in range(bits.shape[1])]
    else:
        planes = [np.ascontiguousarray(rows[:, k]).tobytes() for k in range(width)]
    press = zstandard.ZstdCompressor(level=3)
    return width, [press.compress(p) for p in planes]


def from_planes(width: int, planes: list[bytes], n_ids: int) -> np.ndarray:
    """The ids of a block, as little-endian unsigned 32-bit integers."""
    out = np.zeros((n_ids, 4), dtype=np.uint8)
    raw = [zstandard.ZstdDecompressor().decompress(p) for p in planes]
    if len(raw) == width:
        for k, plane in enumerate(raw):
            out[:, k] = np.frombuffer(plane, dtype=np.uint8)
    else:
        bits = np.stack([np.unpackbits(np.frombuffer(p, dtype=np.uint8), count=n_ids, bitorder="little") for p in raw], axis=1)
        out[:, :width] = np.packbits(bits, axis=1, bitorder="little")
    return out.reshape(-1).view("<u4")


def apart(texts: pa.Array) -> pa.Array:
    """Texts without nulls, A-Z lower-cased, with a blank wherever a letter and a mark of KIND meet: the same ids from
    fewer different words. As they are, if one may hold a special string, which counts as it is written."""
    wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    if not len(texts) or data is None:
        return texts
    offsets = np.frombuffer(offsets, wide)[texts.offset: texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8)[offsets[0]: offsets[-1]]
    if b"<|" in raw.tobytes():
        return texts
    kind = KIND[raw]
    at = np.flatnonzero(kind[:-1] + kind[1:] == 3)
    # A pair of marks adds up to 4, a pair of letters to 2.
    low = np.insert(LOWER[raw], at + 1, 0x20)
    moved = offsets - offsets[0]
    moved += np.searchsorted(at + 1, moved).astype(wide)
    return pa.Array.from_buffers(texts.type, len(texts), [None, pa.py_buffer(moved), pa.py_buffer(low)])


class Encoder:
    """Ids of texts for a tokenizer that drops white space: no token crosses an ASCII blank, so the ids
    of a text are those of its blank-separated words, and a word is encoded once while remembered.

    The tokenizer lower-cases a word and cuts it where letters, digits and marks meet, and no token
    crosses such a cut either. New words of plain letters and marks are cut here in the same way, so
    that words which differ in case or punctuation share their stem's ids; others stay whole.

    Before that, whole batches are lower-cased and cut beside common marks (:func:`apart`). New words of small letters
    and new pieces of plain characters go to the tokenizer's model, in its byte alphabet. Others go through
    the whole tokenizer in one text, with a control character between them, whose id then marks where each
    piece's ids end; those that hold that character are encoded by themselves. What was used since the last
    turnover, or since the one before, is remembered.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # A word of one control character stands between words; its id shows where each word's ids end.
        found = self._ids(MARK)
        self.mark_id = int(found[0]) if len(found) == 1 else None
        self.model, cut = self.tokenizer.model, self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.alphabet = {c: "".join(part for part, _ in cut(chr(c))) for c in (*range(0x21, 0x7F), *range(0xC0, 0x100))}
        self.words, self.pieces = Memory(REMEMBERED), Memory(REMEMBERED)

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def _encode(self, pieces: list[str]) -> dict[str, bytes]:
        out, odd, rest = {}, [], []
        plain, ids_of = PLAIN.fullmatch, self.model.tokenize
        for w in pieces:
            if plain(w) and "<|" not in w:
                spelled = w if w.isascii() else w.translate(self.alphabet)
                out[w] = array("I", [t.id for t in ids_of(spelled)]).tobytes()
            else:
                (odd if self.mark_id is None or MARK in w else rest).append(w)
        out |= {w: self._ids(w).tobytes() for w in odd}
        if rest:
            ids = self._ids(f" {MARK} ".join(rest))
            ends = np.append(np.flatnonzero(ids == self.mark_id), len(ids)).tolist()
            raw, start = ids.tobytes(), 0
            for w, end in zip(rest, ends):
                out[w] = raw[4 * start: 4 * end]
                start = end + 1
        return out

    def many(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text of an array of strings.

        Arrow cuts the texts at blanks and numbers their different words; only those are looked up in Python.
        Every word's ids are then taken from those of the different ones by their numbers.
        """
        split = pc.ascii_split_whitespace(apart(pc.fill_null(texts, "")))
        numbered = split.flatten().dictionary_encode()
        different = numbered.dictionary.to_numpy(zero_copy_only=False).tolist()
        fresh, plain, cut = self.words.missing(set(different)), [], {}
        for w in fresh:
            if w.isalpha() and w.isascii() and w.islower():
                plain.append(w)
            else:
                cut[w] = cut_word(w)
        pieces = self.pieces.missing(set().union(*cut.values()))
        ids_of, get = self.model.tokenize, self.words.young
        for w in plain:
            get[w] = array("I", [t.id for t in ids_of(w)]).tobytes()
        self.pieces.young |= self._encode(pieces)
        piece = self.pieces.young
        for w, parts in cut.items():
            get[w] = piece[parts[0]] if len(parts) == 1 else b"".join([piece[p] for p in parts])
        found = [get[w] for w in different]
        self.words.turn(fresh)
        self.pieces.turn(pieces)

        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        starts = np.cumsum(sizes) - sizes
        known = np.frombuffer(b"".join(found), dtype="<u4")
        number = numbered.indices.to_numpy()
        size = sizes[number]
        ends = np.cumsum(size)
        ids = known[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[number] - ends + size, size)]
        words = split.offsets.to_numpy() - split.offsets[0].as_py()
        at = np.append(0, ends)[words]
        return [ids[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]


class Memory:
    """Answers used of late: between ``most`` and twice as many, of keys up to ``REMEMBERED_BYTES``."""

    def __init__(self, most: int):
        self.most, self.young, self.old = most, {}, {}

    def missing(self, keys: set) -> list:
        """The keys without an answer; the answers of the others are in ``young`` afterwards."""
        young, old, absent = self.young, self.old, []
        for k in keys.difference(young):
            if k in old:
                young[k] = old[k]
            else:
                absent.append(k)
        return absent

    def turn(self, fresh) -> None:
        """Forget what is too long of the ``fresh`` keys and, when it is time, what wasn't used of late."""
        for k in fresh:
            if len(k) > REMEMBERED_BYTES:
                del self.young[k]
        if len(self.young) > self.most:
            self.old, self.young = self.young, {}


def cut_word(word: str) -> list[str]:
    """The pieces of a word of printable Latin-1 characters; any other word whole, and one that may
    hold a special string."""
    if PLAIN.fullmatch(word) and "<|" not in word:
        return PIECE.findall(word.lower())
    return [word]


def write_token_planes(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, unit: str = "byte",
                       block_ids: int = BLOCK_IDS, shard_bytes: int = SHARD_BYTES) -> None:
    """Encode (doc_id, text, ...) and write the ids of all documents, in ascending doc_id order, to ``path``.

    The format is one Parquet row per block of ``block_ids`` ids: its shard and number, its first id's
    place in the shard, its planes (each a zstandard frame), and the chunk index, a list of the
    documents in the block with place and length. Shards are ranges of doc_id in ascending order and
    blocks run on over documents; only a shard's last block is shorter.

    Cases: a null or empty text has only the end id; rows that share a doc_id (null is one, and comes
    first) count as one document, with the smallest text; further columns are ignored; an empty table
    writes no block; a text may span many blocks.

    Spark's own writer commits the files, so a task that runs again replaces its earlier attempt. Tasks get the texts
    in small batches, and an encoder goes with its task, so a worker that waits for other work holds neither.
    """
    docs = one_per_id(docs, "doc_id", "text")
    total = docs.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    shards = max(1, min(total[0], max(docs.sparkSession.sparkContext.defaultParallelism, -(-(total[1] or 0) // shard_bytes))))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard = Encoder(tokenizer_path), TaskContext.get().partitionId()
        waiting: list[np.ndarray] = []
        held, block, first, seq = 0, 0, 0, 0
        listed: list[dict] = []

        def row(ids: np.ndarray) -> dict:
            nonlocal block, first, listed
            width, planes = to_planes(ids, unit)
            made = {"shard": shard, "block": block, "first_id": first, "n_ids": len(ids), "width": width,
                    "planes": planes, "docs": listed}
            block, first, listed = block + 1, first + len(ids), []
            return made

        def encoded(batch: pa.RecordBatch) -> Iterator[tuple[int | None, np.ndarray]]:
            taken = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)) // TOGETHER
            cuts = [0, *(np.flatnonzero(np.diff(taken)) + 1).tolist(), batch.num_rows]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                part = batch.slice(lo, hi - lo)
                for doc_id, ids in zip(part.column(0).to_pylist(), encoder.many(part.column(1))):
                    yield doc_id, np.append(ids, np.uint32(end_id))

        for batch in batches:
            rows = []
            for doc_id, ids in encoded(batch):
                whole = held + len(ids) <= block_ids
                while len(ids):
                    part, ids = ids[: block_ids - held], ids[block_ids - held:]
                    listed.append({"seq": seq, "doc_id": doc_id, "start": held, "n": len(part), "whole": whole})
                    waiting.append(part)
                    held += len(part)
                    if held == block_ids:
                        rows.append(row(np.concatenate(waiting)))
                        waiting, held = [], 0
                seq += 1
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=_BLOCK_ARROW)
        if held:
            yield pa.RecordBatch.from_pylist([row(np.concatenate(waiting))], schema=_BLOCK_ARROW)

    blocks = docs.repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id").mapInArrow(encode, BLOCKS)
    with arrow_batches(docs.sparkSession, *BATCH):
        blocks.write.option("compression", "none").option("parquet.block.size", GROUP_BYTES).parquet(path)


_BLOCK_ARROW = pa.schema([
    ("shard", pa.int32()), ("block", pa.int32()), ("first_id", pa.int64()), ("n_ids", pa.int32()),
    ("width", pa.int32()), ("planes", pa.list_(pa.binary())),
    ("docs", pa.list_(pa.struct([("seq", pa.int32()), ("doc_id", pa.int64()), ("start", pa.int32()),
                                 ("n", pa.int32()), ("whole", pa.bool_())]))),
])


def read_token_planes(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in files of :func:`write_token_planes`.

    ``start`` counts the ids of all documents before. Blocks are read independently: documents inside
    one block are finished there, and only the pieces of documents that cross blocks are shuffled.
    """
    blocks = spark.read.schema(BLOCKS).parquet(path)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                block = batch.slice(k, 1).to_pylist()[0]
                raw = from_planes(block["width"], block["planes"], block["n_ids"]).tobytes()
                out = []
                for d in block["docs"]:
                    piece = raw[4 * d["start"]: 4 * (d["start"] + d["n"])]
                    out.append({"shard": block["shard"], "seq": d["seq"], "doc_id": d["doc_id"], "block": block["block"],
                                "place": block["first_id"] + d["start"], "n": d["n"],
                                "crc": zlib.crc32(piece) if d["whole"] else None, "piece": None if d["whole"] else piece})
                yield pa.RecordBatch.from_pylist(out, schema=_PIECE_ARROW)

    pieces = blocks.mapInArrow(decode, "shard int, seq int, doc_id long, block int, place long, n int, crc long, piece binary")
    whole = pieces.where("piece IS NULL").select("shard", "doc_id", "place", F.col("n").cast("long").alias("n_tokens"),
                                                 F.col("crc").alias("ids_crc32"))
    in_order = F.array_sort(F.collect_list(F.struct("block", "piece")))
    crossing = (pieces.where("piece IS NOT NULL").groupBy("shard", "seq", "doc_id")
                .agg(F.min("place").alias("place"), F.sum("n").alias("n_tokens"), in_order.alias("parts"))
                .select("shard", "doc_id", "place", "n_tokens",
                        F.crc32(F.aggregate("parts", F.lit(b""), lambda s, p: F.concat(s, p["piece"]))).alias("ids_crc32")))
    # One row per shard: the window below sees as many rows as there were shards.
    sizes = blocks.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    before = F.sum("ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("shard", F.coalesce(before, F.lit(0)).alias("base"))
    return (whole.unionByName(crossing).join(starts, "shard")
            .select("doc_id", (F.col("base") + F.col("place")).alias("start"), "n_tokens", "ids_crc32"))


_PIECE_ARROW = pa.schema([("shard", pa.int32()), ("seq", pa.int32()), ("doc_id", pa.int64()), ("block", pa.int32()),
                          ("place", pa.int64()), ("n", pa.int32()), ("crc", pa.int64()), ("piece", pa.binary())])


def encode_documents(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", end_id: int = 2) -> DataFrame:
    """Write the token files of ``docs`` to a new folder of the shared storage and read them back, a few blocks at a
    time; so that this holds whenever the rows are used, they are written once."""
    spark = docs.sparkSession
    path = f"{shared_dir(spark)}/token-planes-{uuid.uuid4().hex}"
    write_token_planes(docs, path, public_tokenizers.path(tokenizer), end_id)
    with arrow_batches(spark, *BLOCK_BATCH):
        return materialise(read_token_planes(spark, path), "token-counts")


def query(spark, sf_dir):
    return encode_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
