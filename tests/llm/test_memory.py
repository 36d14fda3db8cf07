import ctypes
import gc
import os
import re

import pytest

from ledgerline.llm import jaccard, langid, pieces, shared

from .helpers import docs

glibc = pytest.mark.skipif(
    not os.path.exists("/proc/self/smaps_rollup") or not hasattr(ctypes.CDLL(None), "malloc_trim"), reason="needs Linux and glibc"
)


def held():
    """MB of this process."""
    gc.collect()
    with open("/proc/self/smaps_rollup") as f:
        return int(re.search(r"\nPss_Anon:\s+(\d+)", f.read())[1]) // 1024


def scattered(kept):
    """A map function that frees 60 MB of texts; the last one stays, so the heap doesn't shrink by itself."""

    def run(batches):
        for batch in batches:
            texts = [b"%d" % i * 600 for i in range(10_000, 30_000)]
            kept.append(texts[-1])
            del texts
            yield batch

    return run


@glibc
def test_freed_memory_is_handed_back():
    kept = []
    before = held()
    assert list(scattered(kept)(iter([1]))) == [1]
    assert held() - before > 40
    assert list(shared.handing_back(scattered(kept))(iter([1, 2]))) == [1, 2]
    assert held() - before < 20


@glibc
def test_handed_back_by_tasks_that_fail_or_stop():
    kept = []

    def fails(batches):
        yield from scattered(kept)(batches)
        raise ValueError("no")

    before = held()
    with pytest.raises(ValueError, match="no"):
        list(shared.handing_back(fails)(iter([1])))
    stopped = shared.handing_back(scattered(kept))(iter([1, 2]))
    assert next(stopped) == 1
    stopped.close()
    assert held() - before < 20


def test_steps_of_the_pipeline_hand_back(spark, monkeypatch):
    import public_tokenizers

    rows = docs(spark, [(1, "some words")])
    seen = []
    for module in (jaccard, langid, pieces):
        monkeypatch.setattr(module, "handing_back", lambda run, m=module: seen.append(m) or run)
    jaccard.shingled(rows, 5, 80, whole=False)
    langid.predict(rows, {"broadcast": None})
    pieces.encode(rows, pieces.load(spark, public_tokenizers.path("piece_bpe_32k.model")))
    assert seen == [jaccard, langid, pieces]
