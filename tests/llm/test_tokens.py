import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerline.llm import tokens
from ledgerline.llm.mph import PerfectHash, fingerprints
from ledgerline.settings import work_dir

from .helpers import docs

FILE = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("n", [0, 1, 7, 5000])
def test_perfect_hash_is_minimal_and_survives_bytes(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 1 << 62, n).astype(np.uint64))
    h = PerfectHash.from_bytes(PerfectHash.build(keys).to_bytes())
    assert sorted(h.slots(keys).tolist()) == list(range(len(keys)))
    assert len(fingerprints(keys)) == len(keys)


def expected(rows):
    t, out, start = Tokenizer.from_file(FILE), [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = t.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


ROWS = [
    (5, "Hello, World! don't STOP 123"), (-3, "naïve café\u00a0x\x1cy e\u0301 İstanbul ΣΑΣ"), (9, None), (2, ""), (70, "a<|endoftext|>b  c" * 3),
    (71, "日本語 \u3000 テキスト 'll 's"), (8, "w" * 5000), (6, "trailing... (marks) [x] a-b c_d"), (5, "Hello again"), (5, "Hello again"), (None, "no key"), (None, None),
]


def test_files_equal_the_library_and_answer_lookups(spark):
    folder = work_dir(spark)
    manifest = tokens.write(docs(spark, ROWS), folder, FILE)
    got = [tuple(r) for r in tokens.digests(manifest).collect()]
    assert sorted(got, key=lambda r: r[1]) == expected(ROWS)
    t = Tokenizer.from_file(FILE)
    shards = [tokens.Shard(r["file"]) for r in manifest.collect()]
    by_key = {k: s.get(k).tolist() for k in (70, 71, 2) for s in shards if s.get(k) is not None}
    assert by_key == {k: t.encode(dict(ROWS[:8])[k], add_special_tokens=False).ids + [2] for k in (70, 71, 2)}
    assert all(s.get(123456) is None for s in shards)


def test_empty_table(spark):
    manifest = tokens.write(docs(spark, []), work_dir(spark), FILE)
    assert tokens.digests(manifest).collect() == []


def test_documents(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    got = [tuple(r) for r in tokens.op6_token_files(spark, "/root/testdata/sf0.001").collect()]
    assert sorted(got, key=lambda r: r[1]) == expected(rows)
