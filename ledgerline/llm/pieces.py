"""SentencePiece encoding and decoding by batched numpy Viterbi.

The model file's pieces and scores are used as they are; nothing is trained. A
text is cut where no piece can reach across (before a space mark that follows
another character, and around characters that no piece has), and every distinct chunk
is encoded once while the worker's bounded memo holds it. Chunks of equal length
advance together, one row each: at every position the hashes of the substrings
that end there probe the sorted hashes of the pieces, and the best way to end
there is kept as a back pointer.

* Unigram models: the best sum of scores.
* BPE models, whose ids do not follow from a sum of scores: the
  encoding of every prefix ends in exactly one piece that forms a valid pair with the last piece
  of the prefix before it. A pair is valid if byte-pair merging its two halves never merges
  across the border: the merges on the right edge of the left piece and on
  the left edge of the right piece are replayed in order of rank, and no
  crossing piece of a better rank may exist. The same recursion runs with that
  test in place of the score, and gives the library's ids.

Characters that no piece has become their UTF-8 byte pieces, or the unknown id
where the model has none. Models with a character map or white-space removal are
refused rather than encoded differently from the library.

Defined results: NULL text gives NULL ids, empty text none; a U+2581 in a text
decodes to a space, as it does in the library; repeated rows are encoded alike; other
columns are kept.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .blocks import mix
from .shared import handing_back, kept, table

SPACE = "▁"
MEMO_BYTES = 100 << 20  # of a worker's memo, by estimate
BATCH = 1 << 19
LONG = 48
_NEVER = np.int64(1 << 60)
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)


def _prefix_hash(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums over the last axis and the inverse powers; a substring's hash is
    mix((sum[end] - sum[start]) * inverse[start])."""
    n = codes.shape[-1]
    p = np.multiply.accumulate(np.array([1] + [_BASE] * n, dtype=np.uint64))
    q = np.multiply.accumulate(np.array([1] + [_BASE_INV] * n, dtype=np.uint64))
    out = np.zeros(codes.shape[:-1] + (n + 1,), dtype=np.uint64)
    np.cumsum(mix(codes.astype(np.uint64) + np.uint64(1)) * p[:-1], axis=-1, out=out[..., 1:])
    return out, q


def _codes(s: str) -> np.ndarray:
    return np.frombuffer(s.encode("utf-32-le"), dtype="<u4")


def _hash(s: str) -> int:
    total, _ = _prefix_hash(_codes(s))
    return int(mix(total[-1:])[0])


class Model:
    """Tables of one model; built once on the driver and broadcast (its size is the vocabulary's)."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        m = pb.ModelProto()
        with open(path, "rb") as f:
            m.ParseFromString(f.read())
        norm, kinds = m.normalizer_spec, pb.ModelProto.SentencePiece
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces:
            raise ValueError("models with a character map or white-space removal are not supported")
        if m.trainer_spec.model_type not in (1, 2) or m.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only unigram and BPE models with white space as prefix are supported")
        if any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in m.pieces):
            raise ValueError("models with user-defined or unused pieces are not supported")
        self.bpe = m.trainer_spec.model_type == 2
        self.dummy_prefix = norm.add_dummy_prefix
        self.unknown = next(i for i, p in enumerate(m.pieces) if p.type == kinds.UNKNOWN)
        self.bytes = [i for i, p in enumerate(m.pieces) if p.type == kinds.BYTE]
        self.bytes = self.bytes if m.trainer_spec.byte_fallback and len(self.bytes) == 256 else None
        self.piece = {p.piece: i for i, p in enumerate(m.pieces) if p.type == kinds.NORMAL}
        if any(c not in self.piece for s in self.piece for c in s):
            raise ValueError("a piece has a character that is no piece itself")
        if any(s[i] == SPACE and s[i - 1] != SPACE for s in self.piece for i in range(1, len(s))):
            raise ValueError("a piece has a space mark after another character")
        self.score = np.array([p.score for p in m.pieces], dtype=np.float32).astype(np.float64)
        self.longest = max(map(len, self.piece))
        ids = np.array(list(self.piece.values()), dtype=np.int64)
        keys = np.array([_hash(s) for s in self.piece], dtype=np.uint64)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], ids[order]
        self.maybe = np.zeros(1 << 20, dtype=bool)
        self.maybe[(self.keys >> np.uint64(44)).astype(np.int64)] = True
        couples = {(ord(a) << 32) | ord(b) for s in self.piece for a, b in zip(s, s[1:])}
        self.couples = np.array(sorted(couples), dtype=np.int64)
        plain = {p.piece: i for i, p in enumerate(m.pieces)}
        out = [b""] * len(plain)
        for s, i in plain.items():
            out[i] = s.replace(SPACE, " ").encode()
        for b, i in enumerate(self.bytes or ()):
            out[i] = bytes([b])
        for i, p in enumerate(m.pieces):
            if p.type == kinds.CONTROL:
                out[i] = b""
            elif p.type == kinds.UNKNOWN:
                out[i] = " ⁇ ".encode()
        self.surface = out
        if self.bpe:
            self._edges(len(m.pieces))

    def _edges(self, n: int) -> None:
        """Ranks by score, and per piece the pieces on its left and right edge as merging
        builds them, from a single character up to the piece itself."""
        scores = sorted({self.score[i] for i in self.piece.values()}, reverse=True)
        rank_of = {s: r for r, s in enumerate(scores)}
        self.rank = np.full(n, _NEVER, dtype=np.int64)
        for i in self.piece.values():
            self.rank[i] = rank_of[self.score[i]]
        depth = self.longest + 1
        self.left = np.full((n, depth), -1, dtype=np.int32)
        self.right = np.full((n, depth), -1, dtype=np.int32)
        self.whole = np.zeros(n, dtype=bool)
        for s, i in self.piece.items():
            parts = list(s)
            left, right = [self.piece[parts[0]]], [self.piece[parts[-1]]]
            while len(parts) > 1:
                best = min(
                    ((self.rank[self.piece[a + b]], k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.piece),
                    default=None,
                )
                if best is None:
                    break
                k = best[1]
                parts[k : k + 2] = [parts[k] + parts[k + 1]]
                if k == 0:
                    left.append(self.piece[parts[0]])
                if k == len(parts) - 1:
                    right.append(self.piece[parts[-1]])
            self.whole[i] = len(parts) == 1
            self.left[i, : len(left)] = left
            self.right[i, : len(right)] = right
        text = {i: s for s, i in self.piece.items()}
        self.size = np.array([len(text.get(i, "")) for i in range(n)], dtype=np.int64)
        total = np.array([int(_prefix_hash(_codes(text.get(i, "")))[0][-1]) for i in range(n)], dtype=np.uint64)
        self.raw = total
        self.power = np.multiply.accumulate(np.array([1] + [_BASE] * self.longest, dtype=np.uint64))

    @classmethod
    def of(cls, tables: dict) -> Model:
        m = cls.__new__(cls)
        m.__dict__.update(tables)
        return m

    def probe(self, h: np.ndarray) -> np.ndarray:
        """Ids of the pieces with these hashes, -1 for none."""
        out = np.full(h.shape, -1, dtype=np.int64)
        at = np.flatnonzero(self.maybe[(h >> np.uint64(44)).astype(np.int64)])
        k = np.searchsorted(self.keys, h[at])
        k[k == len(self.keys)] = 0
        hit = self.keys[k] == h[at]
        out[at[hit]] = self.ids[k[hit]]
        return out

    def valid_pairs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging the texts of the pieces a and b together gives a, b again."""
        good = self.whole[a] & self.whole[b]
        open_ = np.flatnonzero(good)
        i, j = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
        while len(open_):
            u, v = a[open_], b[open_]
            x, y = self.right[u, i[open_]].astype(np.int64), self.left[v, j[open_]].astype(np.int64)
            nx, ny = self.right[u, i[open_] + 1], self.left[v, j[open_] + 1]
            px = np.where(nx < 0, _NEVER, self.rank[nx])
            py = np.where(ny < 0, _NEVER, self.rank[ny])
            both = self.size[x] + self.size[y] <= self.longest
            across = np.full(len(x), _NEVER)
            if both.any():
                xs, ys = x[both], y[both]
                p = self.probe(mix(self.raw[xs] + self.raw[ys] * self.power[self.size[xs]]))
                across[both] = np.where(p < 0, _NEVER, self.rank[p])
            # on equal ranks the leftmost merge comes first
            bad = (across < px) & (across <= py) & (across < _NEVER)
            good[open_[bad]] = False
            step = ~bad & ((px < _NEVER) | (py < _NEVER))
            first = px <= py
            i[open_[step & first]] += 1
            j[open_[step & ~first]] += 1
            open_ = open_[step]
        return good


class Encoder(dict):
    """Chunk -> ids as little-endian 32-bit bytes, for one worker."""

    def __init__(self, model: Model):
        super().__init__()
        self.m = model
        self._known = set(c for c in model.piece if len(c) == 1)
        after = {y for s in model.piece for x, y in zip(s, s[1:]) if x.isalpha()}
        group = lambda chars: "".join(map(re.escape, chars))
        known = group(self._known - {SPACE})
        alpha = group(c for c in self._known if c.isalpha())
        # a run of letters is cut off where no piece has the next character after a letter
        joined = group(after - {SPACE})
        self._chunk = re.compile(f"{SPACE}*+[{alpha}]++(?![{joined}])|{SPACE}*+[{known}]++|{SPACE}++|[^{SPACE}{known}]++")
        self._pairs = np.full(1 << 21, -1, dtype=np.int64)
        self._verdict = np.zeros(1 << 21, dtype=bool)
        self._bytes = 0

    def chunks(self, text: str) -> list[str]:
        if not text:
            return []
        return self._chunk.findall((SPACE if self.m.dummy_prefix else "") + text.replace(" ", SPACE))

    def texts(self, texts: list[str]) -> list[bytes]:
        """Ids of each text."""
        if self._bytes > MEMO_BYTES:
            self.clear()
            self._bytes = 0
        cut = [self.chunks(t) for t in texts]
        new = set().union(*cut).difference(self) if cut else set()
        by_length: dict[int, list[str]] = {}
        for c in new:
            if c[0] not in self._known:
                self[c] = self._unknown(c)
            elif len(c) > LONG:
                self[c] = self._long(c)
            else:
                by_length.setdefault(len(c), []).append(c)
        for n, words in by_length.items():
            for at in range(0, len(words), max(1, BATCH // n)):
                part = words[at : at + max(1, BATCH // n)]
                for w, ids in zip(part, self._viterbi(part, n)):
                    self[w] = ids
        get = self.__getitem__
        self._bytes += sum(130 + 2 * len(c) + len(get(c)) for c in new)
        return [b"".join(map(get, c)) for c in cut]

    def _unknown(self, c: str) -> bytes:
        ids = [self.m.bytes[b] for b in c.encode()] if self.m.bytes else [self.m.unknown]
        return np.array(ids, dtype="<i4").tobytes()

    def _pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """valid_pairs through a direct-mapped memo."""
        key = a * len(self.m.score) + b
        slot = (mix(key.astype(np.uint64)) >> np.uint64(43)).astype(np.int64)
        miss = np.flatnonzero(self._pairs[slot] != key)
        out = self._verdict[slot]
        if len(miss):
            new, back = np.unique(key[miss], return_inverse=True)
            good = self.m.valid_pairs(new // len(self.m.score), new % len(self.m.score))
            out[miss] = good[back]
            self._pairs[slot[miss]] = key[miss]
            self._verdict[slot[miss]] = out[miss]
        return out

    def _viterbi(self, words: list[str], n: int) -> list[bytes]:
        m = self.m
        total, inverse = _prefix_hash(_codes("".join(words)).reshape(len(words), n))
        best = np.full((len(words), n + 1), -np.inf)
        last = np.full((len(words), n + 1), -1, dtype=np.int64)
        back = np.zeros((len(words), n + 1), dtype=np.int64)
        best[:, 0] = 0
        for j in range(1, n + 1):
            for i in range(max(0, j - m.longest), j):
                p = m.probe(mix((total[:, j] - total[:, i]) * inverse[i]))
                at = np.flatnonzero((p >= 0) & (best[:, i] > -np.inf))
                if not len(at):
                    continue
                p = p[at]
                if m.bpe:
                    if i == 0:
                        at, p = at[m.whole[p]], p[m.whole[p]]
                    else:
                        good = self._pair(last[at, i], p)
                        at, p = at[good], p[good]
                    value = np.zeros(len(at))
                else:
                    value = best[at, i] + m.score[p]
                better = value > best[at, j]
                at, p = at[better], p[better]
                best[at, j], last[at, j], back[at, j] = value[better], p, i
        # follow the back pointers of all words together
        out = np.full((len(words), n), -1, dtype="<i4")
        pos = np.full(len(words), n)
        col = n
        while (pos > 0).any():
            col -= 1
            live = np.flatnonzero(pos > 0)
            out[live, col] = last[live, pos[live]]
            pos[live] = back[live, pos[live]]
        return [row[row >= 0].tobytes() for row in out]

    def _long(self, c: str) -> bytes:
        """A long chunk: cut between characters that no piece has side by side, the rest one by one."""
        codes = _codes(c).astype(np.int64)
        couple = (codes[:-1] << 32) | codes[1:]
        at = np.searchsorted(self.m.couples, couple)
        at[at == len(self.m.couples)] = 0
        cuts = np.flatnonzero(self.m.couples[at] != couple) + 1 if len(self.m.couples) else np.arange(1, len(c))
        bounds = [0, *cuts.tolist(), len(c)]
        parts = [c[a:b] for a, b in zip(bounds, bounds[1:])]
        out = []
        for p in parts:
            if len(p) > LONG:
                out.append(self._scalar(p))
            else:
                out.append(self.get(p) or self._viterbi([p], len(p))[0])
        return b"".join(out)

    def _scalar(self, c: str) -> bytes:
        m, n = self.m, len(c)
        best, last, back = [0.0] + [-np.inf] * n, [-1] * (n + 1), [0] * (n + 1)
        seen: dict[tuple[int, int], bool] = {}
        for j in range(1, n + 1):
            for i in range(max(0, j - m.longest), j):
                p = m.piece.get(c[i:j])
                if p is None or best[i] == -np.inf:
                    continue
                if m.bpe:
                    if i == 0:
                        good = m.whole[p]
                    else:
                        good = seen.get((last[i], p))
                        if good is None:
                            good = seen[last[i], p] = bool(m.valid_pairs(np.array([last[i]]), np.array([p]))[0])
                    value = 0.0 if good else -np.inf
                else:
                    value = best[i] + m.score[p]
                if value > best[j]:
                    best[j], last[j], back[j] = value, p, i
        ids = []
        while n:
            ids.append(last[n])
            n = back[n]
        return np.array(ids[::-1], dtype="<i4").tobytes()


def decode_ids(model: Model, ids: np.ndarray) -> str:
    raw = b"".join([model.surface[i] for i in ids.tolist()])
    text = raw.decode("utf-8", errors="replace")
    return text[1:] if model.dummy_prefix and text[:1] == " " else text


def _groups(texts: list, limit: int = 1 << 22) -> Iterator[tuple[int, int]]:
    at, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size > limit:
            yield at, i + 1
            at, size = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


class Loaded(NamedTuple):
    """A broadcast model and the digest of its file, the name its encoder has in the workers."""

    broadcast: object
    key: str

    def model(self) -> Model:
        return self.encoder().m

    def encoder(self) -> Encoder:
        return kept(("pieces", self.key), lambda: Encoder(Model.of(self.broadcast.value)))


def _encoder(loaded: Loaded, position: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = loaded.encoder()
        for batch in batches:
            texts = batch.column(position).to_pylist()
            for a, b in _groups(texts):
                ids = encoder.texts([t or "" for t in texts[a:b]])
                flat = np.frombuffer(b"".join(ids), dtype="<i4")
                bounds = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])]).astype(np.int32)
                mask = pa.array([t is None for t in texts[a:b]])
                array = pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat), mask=mask)
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns, array], names=[*part.schema.names, "ids"])

    return run


def _decoder(loaded: Loaded, position: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = loaded.model()
        for batch in batches:
            ids = batch.column(position)
            out = [None if x is None else decode_ids(model, np.array(x, dtype=np.int64)) for x in ids.to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], names=[*batch.schema.names, "decoded"])

    return run


def load(spark: SparkSession, model_file: str) -> Loaded:
    with open(model_file, "rb") as f:
        digest = hashlib.file_digest(f, "sha256").hexdigest()
    return Loaded(spark.sparkContext.broadcast(Model(model_file).__dict__), digest)


def encode(docs: DataFrame, model, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` array<int> (a column of that name is replaced). ``model``: from ``load``."""
    docs = docs.drop("ids")
    schema = T.StructType(docs.schema.fields + [T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return docs.mapInArrow(handing_back(_encoder(model, docs.columns.index(text))), schema)


def decode(rows: DataFrame, model, ids: str = "ids") -> DataFrame:
    """``rows`` with ``decoded`` string (a column of that name is replaced)."""
    rows = rows.drop("decoded")
    schema = T.StructType(rows.schema.fields + [T.StructField("decoded", T.StringType())])
    return rows.mapInArrow(_decoder(model, rows.columns.index(ids)), schema)


def _round_trip(loaded: Loaded):
    encode_all = _encoder(loaded, 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = loaded.model()
        for batch in encode_all(batches):
            texts = batch.column(1).to_pylist()
            n, crc, same = [], [], []
            for t, x in zip(texts, batch.column(2)):
                ids = np.zeros(0, "<i4") if t is None else x.values.to_numpy().astype("<i4")
                n.append(len(ids))
                crc.append(zlib.crc32(ids.tobytes()))
                same.append(t is None or decode_ids(model, ids) == t.replace(SPACE, " "))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(crc, pa.int64()), pa.array(same)],
                names=["doc_id", "n_tokens", "ids_crc32", "round_trip"],
            )

    return run


def op3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encodes every text, decodes the ids, and compares: doc_id, n_tokens, ids_crc32 of the ids as
    little-endian 32-bit integers, round_trip."""
    import public_tokenizers

    model = load(spark, public_tokenizers.path("piece_bpe_32k.model"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.mapInArrow(_round_trip(model), "doc_id long, n_tokens long, ids_crc32 long, round_trip boolean")
