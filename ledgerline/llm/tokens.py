"""Token-id files with a minimal perfect hash index.

Documents are range-partitioned and sorted by doc_id; each partition becomes one
shard of two files, written by its task while the texts stream through:

* ``shard-*.bin``: magic, version, bytes per id (2 if the vocabulary allows, else 4), then
  nothing but the little-endian ids, document after document;
* ``shard-*.idx``: the doc_ids and the offsets in the payload in file order, a
  minimal perfect hash of the distinct doc_ids, and per slot of it a 32-bit fingerprint of
  the key and the key's first place in file order.

A lookup hashes the key to its slot, compares the fingerprint, and reads ids from
one offset to the next: constant time, no search. A task that is run again writes new
files under another name; only files named in the manifest (a written table of
one row per shard, from the tasks that succeeded) are ever read.

Texts are encoded by the tokenizers library. Where its pre-tokenizer drops white space and
never joins pieces across it, a text is encoded in white-space-delimited
chunks, each distinct chunk once while the worker's bounded memo holds it.

Defined results: NULL or empty text has only the end id; rows with NULL doc_id come
first and are not in the index (they are read in file order); rows repeating a doc_id
are neighbours in file order, by text, and a lookup returns the first; an empty table
gives an empty manifest; other columns are ignored.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.settings import checkpoint_dir

from .mph import PerfectHash, fingerprints
from .shared import kept, table

MAGIC = b"LEDGTOK1"
HEAD = "<8sII"
HEAD_SIZE = 16
MEMO_BYTES = 80 << 20  # of a worker's memo, by estimate
END_ID = 2
#: Control characters that Python's split() takes for white space and the tokenizer does not.
_ODD = re.compile("[\x1c-\x1f]")
#: Latin-1 letters (no change under NFC, simple lower case) followed by ASCII marks other than
#: the apostrophe: the pre-tokenizer cuts these between the two.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")


def _open(uri: str):
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for the
    characters from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(256 + i) for i, b in enumerate(hidden)}


def _by_words(tokenizer_file: str) -> bool:
    """Whether the tokenizer lower-cases, drops white space, cuts letters from marks and then works on bytes."""
    with open(tokenizer_file, encoding="utf-8") as f:
        t = json.load(f)
    norm = [n.get("type") for n in (t.get("normalizer") or {}).get("normalizers", [])]
    split, *rest = (t.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
    return (
        norm == ["NFC", "Replace", "Lowercase"]
        and split.get("behavior") == "Removed" and split.get("invert") is True
        and split.get("pattern", {}).get("Regex", "").endswith(r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        and [r.get("type") for r in rest] == ["ByteLevel"] and not rest[0].get("add_prefix_space")
        and t["model"]["type"] == "BPE" and not t["model"].get("dropout")
    )


class _Chunks(dict):
    """Chunk of a text -> its ids as bytes. Words of plain letters go straight to the library's
    model, other chunks through all of its steps; a tokenizer of another make gets whole texts."""

    def __init__(self, tokenizer_file: str, dtype: str):
        from tokenizers import Tokenizer

        super().__init__()
        self._bytes = 0
        tokenizer = Tokenizer.from_file(tokenizer_file)
        self._whole = not _by_words(tokenizer_file)
        self._pack = lambda ids: np.array(ids, dtype=dtype).tobytes()
        self._encode = lambda s: self._pack(tokenizer.encode(s, add_special_tokens=False).ids)
        model, table_ = tokenizer.model, _byte_letters()
        self._word = lambda w: self._pack([x.id for x in model.tokenize(w.encode().decode("latin-1").translate(table_))])

    def __missing__(self, chunk: str) -> bytes:
        m = _PLAIN.fullmatch(chunk)
        if m is None:
            out = self._encode(chunk)
        elif m[2]:
            out = self[m[1].lower()] + self[m[2]]
        else:
            low = chunk.lower()
            out = self._word(low) if low == chunk else self[low]
        self[chunk] = out
        self._bytes += 130 + 2 * len(chunk) + len(out)
        return out

    def text(self, s: str) -> bytes:
        if self._whole or _ODD.search(s):
            return self._encode(s)
        if self._bytes > MEMO_BYTES:
            self.clear()
            self._bytes = 0
        return b"".join(map(self.__getitem__, s.split()))


def _writer(folder: str, tokenizer_file: str, dtype: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        chunks = kept(("tokens", tokenizer_file, dtype), lambda: _Chunks(tokenizer_file, dtype))
        end = np.array([end_id], dtype=dtype).tobytes()
        width = len(end)
        shard = TaskContext.get().partitionId()
        name = f"shard-{shard:06d}-{uuid.uuid4().hex}"
        fs, path = _open(folder)
        keys, lengths, nulls, sink = [], [], 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            if sink is None:
                fs.create_dir(path, recursive=True)
                sink = fs.open_output_stream(f"{path}/{name}.bin")
                sink.write(struct.pack(HEAD, MAGIC, 1, width))
            nulls += batch.column(0).null_count
            keys.append(batch.column(0).fill_null(0).to_numpy())
            held = []
            size = 0
            for value in batch.column(1):
                text = value.as_py()
                ids = (chunks.text(text) if text else b"") + end
                lengths.append(len(ids) // width)
                held.append(ids)
                size += len(ids)
                if size > 4 << 20:
                    sink.write(b"".join(held))
                    held, size = [], 0
            sink.write(b"".join(held))
        if sink is None:
            return
        sink.close()
        ids = np.concatenate(keys).astype(np.int64)
        offsets = np.concatenate([[0], np.cumsum(lengths)]).astype("<i8")
        distinct, first = np.unique(ids[nulls:], return_index=True)
        k = distinct.view(np.uint64)
        mph = PerfectHash.build(k)
        slot = mph.slots(k)
        prints, place = np.zeros(len(k), "<u4"), np.zeros(len(k), "<i8")
        prints[slot], place[slot] = fingerprints(k), first + nulls
        blob = mph.to_bytes()
        with fs.open_output_stream(f"{path}/{name}.idx") as out:
            out.write(struct.pack("<8sQQQQ", MAGIC, len(ids), nulls, len(k), len(blob)))
            for part in (ids.astype("<i8").tobytes(), offsets.tobytes(), prints.tobytes(), place.tobytes(), blob):
                out.write(part)
        yield pa.RecordBatch.from_pydict(
            {"shard": [shard], "file": [f"{folder}/{name}"], "n_docs": [len(ids)], "n_ids": [int(offsets[-1])]},
            schema=pa.schema([("shard", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]),
        )

    return run


class Shard:
    """One shard, opened by the name in the manifest."""

    def __init__(self, file: str):
        self._fs, self._path = _open(file)
        with self._fs.open_input_file(self._path + ".idx") as f:
            raw = f.read()
        magic, n, self.nulls, k, size = struct.unpack_from("<8sQQQQ", raw)
        if magic != MAGIC:
            raise ValueError(f"{file}.idx is not a token index")
        at = struct.calcsize("<8sQQQQ")
        self.keys = np.frombuffer(raw, "<i8", n, at)
        self.offsets = np.frombuffer(raw, "<i8", n + 1, at := at + 8 * n)
        self._prints = np.frombuffer(raw, "<u4", k, at := at + 8 * (n + 1))
        self._place = np.frombuffer(raw, "<i8", k, at := at + 4 * k)
        self._mph = PerfectHash.from_bytes(raw[at + 8 * k : at + 8 * k + size])
        self._data = self._fs.open_input_file(self._path + ".bin")
        magic, _, self._width = struct.unpack(HEAD, self._data.read_at(HEAD_SIZE, 0))
        if magic != MAGIC:
            raise ValueError(f"{file}.bin is not a token file")

    def places(self, keys: np.ndarray) -> np.ndarray:
        """First place in file order of each key; -1 for keys that are not in the shard."""
        k = keys.astype(np.int64).view(np.uint64)
        slot = self._mph.slots(k)
        known = slot >= 0
        known[known] = self._prints[slot[known]] == fingerprints(k[known])
        return np.where(known, self._place[np.where(known, slot, 0)] if len(self._place) else -1, -1)

    def read(self, first: int, last: int) -> np.ndarray:
        """Ids of the documents first to last - 1 in file order, as unsigned 32-bit integers."""
        a, b = int(self.offsets[first]), int(self.offsets[last])
        raw = self._data.read_at((b - a) * self._width, HEAD_SIZE + a * self._width)
        return np.frombuffer(raw, f"<u{self._width}").astype("<u4")

    def get(self, key: int) -> np.ndarray | None:
        place = int(self.places(np.array([key]))[0])
        return None if place < 0 else self.read(place, place + 1)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, before) -> doc_id, start, n_tokens, ids_crc32 of every document in the shard, found by its key."""
    for batch in batches:
        for file, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            s = Shard(file)
            n = len(s.keys)
            place = np.arange(n)
            key = s.keys[s.nulls :]
            place[s.nulls :] = s.places(key)
            # rows that repeat a key follow the first one
            repeat = np.arange(n) - np.concatenate([np.arange(s.nulls), s.nulls + np.searchsorted(key, key, side="left")])
            place = place + repeat
            if (place[s.nulls :] < 0).any():
                raise ValueError(f"{file}: a key is not in its index")
            at = 0
            while at < n:
                upto = int(np.searchsorted(s.offsets, s.offsets[at] + (1 << 20), side="right")) - 1
                upto = min(n, max(upto, at + 1))
                starts, ends = s.offsets[place[at:upto]], s.offsets[place[at:upto] + 1]
                base, ids = int(starts.min()), memoryview(s.read(int(place[at:upto].min()), int(place[at:upto].max()) + 1)).cast("B")
                crc = [zlib.crc32(ids[4 * (a - base) : 4 * (b - base)]) for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(s.keys[at:upto], mask=np.arange(at, upto) < s.nulls),
                        pa.array(starts + before),
                        pa.array(ends - starts),
                        pa.array(crc, pa.int64()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )
                at = upto


def write(docs: DataFrame, folder: str, tokenizer_file: str, end_id: int = END_ID) -> DataFrame:
    """Write the shards below ``folder`` and return the manifest: shard, file, n_docs, n_ids."""
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    vocabulary = max(Tokenizer.from_file(tokenizer_file).get_vocab_size(), end_id + 1)
    dtype = "<u2" if vocabulary <= 1 << 16 else "<u4"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ranged = rows.repartitionByRange(parts, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    manifest = ranged.mapInArrow(_writer(folder, tokenizer_file, dtype, end_id), "shard int, file string, n_docs long, n_ids long")
    manifest.write.parquet(f"{folder}/manifest")
    return spark.read.schema(manifest.schema).parquet(f"{folder}/manifest")


def digests(manifest: DataFrame) -> DataFrame:
    """Reads every shard back. The window runs over one row per shard."""
    before = F.coalesce(F.sum("n_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = manifest.select("file", before.alias("before"), "shard").repartition(parts, "shard").select("file", "before")
    return shards.mapInArrow(_digests, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = f"{checkpoint_dir(spark).rstrip('/')}/ledgerline-llm/tokens-{uuid.uuid4().hex[:12]}"
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digests(write(docs, folder, public_tokenizers.path("word_bpe_49k.json")))
