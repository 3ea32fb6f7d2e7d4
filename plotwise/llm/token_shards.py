"""Training-order materialisation of token sequences as binary shards.

Documents are tokenised (byte-level BPE ranks from a vocabulary file), each closed by an end token, and packed
into sequences of a fixed number of tokens. A keyed Feistel permutation with cycle-walking gives every sequence
a global slot; range partitions of slots write shards of fixed stride, so any reader finds slot s at byte
(s mod slots per shard) * stride of shard s div slots per shard, reads sequentially and resumes anywhere.

Sequences are staged once (compressed) in the shared folder; their number within the staged files is
the index that is permuted, so a repeated task gives the same slots. Shards are written under a
temporary name and then moved: a lost task writes the same bytes again.

Defined results: null and empty texts give the end token alone; long texts run over as many sequences as
they need; the last sequence of a staged file is filled up with end tokens (``n_tokens`` counts the real ones);
repeated rows and null ids are packed like any others; an empty table gives no shards; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import tiktoken
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plotwise.llm.tables import new_path, resident, unstage
from plotwise.llm.text import mix, slices

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Splitting pattern of the vocabulary (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
END = 50256
SEQUENCE = 2048
#: Slots of a shard (64 MB at two bytes a token).
SHARD_SLOTS = 16_384
KEY = "order-1"
ROUNDS = 6
#: Bytes of text that are encoded at once; characters from which a text's ids never are Python numbers.
ENCODE_BYTES, LONG = 1 << 18, 100_000
#: Most staged files whose counts are broadcast (about 100 bytes each).
MAX_FILES = 1_000_000


class Encoder:
    """Token ids of texts; splitting and merging run in the tokenizer's native code."""

    def __init__(self, vocabulary: bytes):
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in vocabulary.splitlines() if line)}
        self.bpe = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the n+1 offsets of the texts."""
        ids = [np.array(self.bpe.encode_ordinary(t), np.uint32) if len(t) < LONG else self.bpe.encode_to_numpy(t, disallowed_special=()) for t in (t or "" for t in texts)]
        off = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int64)
        return np.concatenate(ids) if ids else np.zeros(0, np.uint32), off


def _encoder(vocabulary: bytes) -> Encoder:
    return resident(("encoder", hashlib.sha256(vocabulary).digest()), lambda: Encoder(vocabulary))


def permute(index: np.ndarray, n: int, key: str = KEY, rounds: int = ROUNDS) -> np.ndarray:
    """A keyed permutation of 0..n-1: a balanced Feistel network over the next even number of bits, walked until
    the value falls below n."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask, seed = np.uint64((1 << half) - 1), np.uint64(zlib.crc32(key.encode()))
    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> np.uint64(half), out[todo] & mask
        for r in range(rounds):
            left, right = right, left ^ (mix(right + (seed << np.uint64(32)) + np.uint64((r + 1) * 0x9E3779B1)) & mask)
        out[todo] = left << np.uint64(half) | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def _width(ids: int) -> np.dtype:
    return np.dtype("<u2") if ids <= 65_536 else np.dtype("<u4")


def _pack_rows(vocabulary, sequence: int, end: int):
    """Documents -> sequences: n_tokens, compressed ids, and which stretches of which documents they hold."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, dtype, z = _encoder(vocabulary.value), _width(end + 1), zstandard.ZstdCompressor(level=6)
        rest, owner, place = np.zeros(0, dtype), np.zeros(0, np.int64), np.zeros(0, np.int64)
        ids_of: list = []

        def emit(ids, owner, place, names, n_real):
            out = []
            for k in range(0, len(ids), sequence):
                own = owner[k : k + sequence]
                real = min(sequence, n_real - k)
                cut = np.flatnonzero(np.concatenate([[True], own[1:real] != own[: real - 1]]))
                sizes = np.diff(np.concatenate([cut, [real]]))
                docs = [{"doc_id": names[own[c]], "token": int(place[k + c]), "at": int(c), "n": int(s)} for c, s in zip(cut.tolist(), sizes.tolist(), strict=True)]
                raw = ids[k : k + sequence].tobytes()
                out.append((real, z.compress(raw), docs))
            kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("token", pa.int64()), ("at", pa.int32()), ("n", pa.int32())]))
            return pa.RecordBatch.from_arrays([pa.array([r for r, *_ in out], pa.int32()), pa.array([c for _, c, _ in out], pa.binary()), pa.array([d for *_, d in out], kind)], ["n_tokens", "packed", "docs"])

        for b in slices(batches, limit=ENCODE_BYTES):
            ids, off = encoder.encode(b.column("text").to_pylist())
            n = np.diff(off) + 1
            stop = np.cumsum(n)
            whole = np.full(int(stop[-1]), end, dtype)
            keep = np.ones(len(whole), bool)
            keep[stop - 1] = False
            whole[keep] = ids
            names = [*ids_of, *b.column("doc_id").to_pylist()]
            owner = np.concatenate([owner, len(ids_of) + np.repeat(np.arange(len(n)), n)])
            place = np.concatenate([place, np.arange(len(whole)) - np.repeat(stop - n, n)])
            rest = np.concatenate([rest, whole])
            full = len(rest) // sequence * sequence
            if full:
                yield emit(rest[:full], owner[:full], place[:full], names, full)
            rest, owner, place = rest[full:], owner[full:], place[full:]
            low = int(owner.min()) if len(owner) else len(names)
            ids_of, owner = names[low:], owner - low
        if len(rest):
            pad = sequence - len(rest)
            yield emit(np.concatenate([rest, np.full(pad, end, dtype)]), np.concatenate([owner, np.full(pad, owner[-1])]), np.concatenate([place, np.zeros(pad, np.int64)]), ids_of, len(rest))

    return rows


def shard_path(folder: str, shard: int) -> str:
    return f"{folder}/shard-{shard:08d}.bin"


def _open_folder(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def _write_rows(folder: str):
    """Sequences sorted by slot -> shard files, and a row for each sequence."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _open_folder(folder)
        shard, sink, name = -1, None, ""

        def close():
            if sink is not None:
                sink.close()
                files.move(name, shard_path(root, shard))

        for b in batches:
            sums, sizes = [], []
            for k, packed in zip(b.column("shard").to_pylist(), b.column("packed").to_pylist(), strict=True):
                if k != shard:
                    close()
                    shard, name = k, f"{root}/_{k:08d}-{np.random.default_rng().integers(1 << 62):x}"
                    sink = files.open_output_stream(name)
                raw = zstandard.decompress(packed)
                sink.write(raw)
                sums.append(zlib.crc32(raw))
                sizes.append(len(raw))
            at = [s % 2**62 for s in b.column("at").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("slot"), b.column("shard"), pa.array([a * n for a, n in zip(at, sizes, strict=True)], pa.int64()), b.column("n_tokens"), pa.array(sums, pa.int64()), b.column("docs")], ["slot", "shard", "byte_offset", "n_tokens", "crc32", "docs"])
        close()

    return rows


def materialise(docs: DataFrame, folder: str | None = None, vocabulary: str = VOCABULARY, sequence: int = SEQUENCE, shard_slots: int = SHARD_SLOTS, end: int = END, key: str = KEY) -> DataFrame:
    """Writes the shards to ``folder`` (default: a new one in the shared folder) and returns a row for each
    sequence: slot, shard, byte_offset, n_tokens, crc32, docs (doc_id, token, at, n: which stretch of tokens of which
    document stands where)."""
    spark = docs.sparkSession
    folder = folder or new_path(spark, "shards")
    files, root = _open_folder(folder)
    files.create_dir(root)
    # the vocabulary is a file of fixed size
    vocabulary = spark.sparkContext.broadcast(Path(vocabulary).read_bytes())
    kind = "docs array<struct<doc_id:bigint,token:bigint,at:int,n:int>>"
    staged = new_path(spark, "sequences")
    packed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_pack_rows(vocabulary, sequence, end), f"n_tokens int, packed binary, {kind}")
    packed.write.option("compression", "zstd").parquet(staged)
    sequences = spark.read.schema(packed.schema).parquet(staged)
    named = sequences.select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    # one row per staged file
    counts = named.groupBy("file").agg(F.count("*").alias("k"))
    starts = counts.withColumn("base", F.sum("k").over(W.orderBy("file").rowsBetween(W.unboundedPreceding, -1))).select("file", F.coalesce("base", F.lit(0)).alias("base"))
    total = counts.agg(F.coalesce(F.sum("k"), F.lit(0)).alias("n"), F.count("*").alias("files")).first()
    n = total["n"]
    starts = F.broadcast(starts) if total["files"] <= MAX_FILES else starts

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            slot = permute(b.column("index").to_numpy(), n, key)
            yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(slot // shard_slots), pa.array(slot % shard_slots), b.column("n_tokens"), b.column("packed"), b.column("docs")], ["slot", "shard", "at", "n_tokens", "packed", "docs"])

    placed = (named.join(starts, "file").select((F.col("base") + F.col("row")).alias("index"), "n_tokens", "packed", "docs")
              .mapInArrow(slots, f"slot long, shard long, at long, n_tokens int, packed binary, {kind}"))
    n_shards = max(1, -(-n // shard_slots))
    written = (placed.repartitionByRange(n_shards, "shard").sortWithinPartitions("slot")
               .mapInArrow(_write_rows(folder), f"slot long, shard long, byte_offset long, n_tokens int, crc32 long, {kind}"))
    index = f"{folder}/index"
    written.write.option("compression", "zstd").parquet(index)
    unstage(sequences)
    return spark.read.schema(written.schema).parquet(index)


def read_slots(folder: str, first: int, n: int, sequence: int = SEQUENCE, shard_slots: int = SHARD_SLOTS, end: int = END) -> np.ndarray:
    """``n`` sequences from slot ``first`` on, by position alone (n x sequence ids)."""
    files, root = _open_folder(folder)
    stride, out = sequence * _width(end + 1).itemsize, []
    while n > 0:
        shard, at = divmod(first, shard_slots)
        take = min(n, shard_slots - at)
        with files.open_input_file(shard_path(root, shard)) as f:
            out.append(f.read_at(take * stride, at * stride))
        first, n = first + take, n - take
    return np.frombuffer(b"".join(out), _width(end + 1)).reshape(-1, sequence)
