"""Hash trees of files against a plain tree over the same bytes."""

import gzip
import hashlib
import os
import random

import pytest

from ledgerline.sources import raw_csv as R
from ledgerline.sources.digest import tree_digests

LEAF, FAN = 64, 3


def plain(data, leaf=LEAF, fan=FAN, levels=6):
    nodes = [hashlib.sha256(b"\0" + data[i : i + leaf]).digest() for i in range(0, len(data), leaf)]
    for _ in range(levels):
        nodes = [hashlib.sha256(b"\1" + b"".join(nodes[i : i + fan])).digest() for i in range(0, len(nodes), fan)]
    assert len(nodes) == 1
    return nodes[0].hex()


def files():
    r = random.Random(3)
    text = lambda n: b"".join(r.choice([b"a", b"\n", b"\r\n", b"\xe7", b"\xff\xfe", b"x;" * r.randrange(40)]) for _ in range(n))
    out = {f"f{i}.csv": text(n) for i, n in enumerate((1, 7, 90, 400, 900))}
    return out | {
        "line.csv": b"q" * 1500,  # longer than leaves and splits
        "feed.csv": b"\n",
        "feeds.csv": b"\n" * 333,
        "even.csv": b"z" * (LEAF - 1) + b"\n",
        "evens.csv": (b"z" * (LEAF - 1) + b"\n") * 9,
        "open.csv": (b"z" * 9 + b"\n") * 50 + b"end",
        "copy.csv": (b"z" * 9 + b"\n") * 50 + b"end",
    }


@pytest.mark.parametrize("split", [37, 200, 1 << 20])
def test_equals_a_plain_tree_however_files_are_split(spark, tmp_lake, split):
    folder = (tmp_lake.removeprefix("file:")) + "/bytes"
    os.makedirs(folder)
    want = {}
    for name, data in files().items():
        with open(f"{folder}/{name}", "wb") as f:
            f.write(data)
        want[name] = (len(data), plain(data))
    open(f"{folder}/empty.csv", "wb").close()
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {k: spark.conf.get(k, None) for k in keys}
    spark.conf.set(keys[0], str(split))
    spark.conf.set(keys[1], "0")
    spark.conf.set(keys[2], "1")
    try:
        got = tree_digests(spark, [folder], leaf=LEAF, fan=FAN, levels=6).collect()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert {r["path"].rsplit("/", 1)[-1]: (r["size"], r["digest"]) for r in got} == want  # a file without bytes has none


def test_without_a_broadcast_of_the_splits(spark, tmp_lake, monkeypatch):
    from ledgerline.sources import digest

    folder = (tmp_lake.removeprefix("file:")) + "/bytes"
    os.makedirs(folder)
    data = files()["f4.csv"]
    with open(f"{folder}/a.csv", "wb") as f:
        f.write(data)
    monkeypatch.setattr(digest, "BROADCAST_SPLITS", 0)
    r = tree_digests(spark, [folder], leaf=LEAF, fan=FAN, levels=6).first()
    assert (r["size"], r["digest"]) == (len(data), plain(data))


def test_packed_files_are_refused_by_name(spark, tmp_lake):
    folder = (tmp_lake.removeprefix("file:")) + "/bytes"
    os.makedirs(folder)
    with gzip.open(f"{folder}/a.csv.gz", "wb") as f:
        f.write(b"one;two\n" * 100)
    with pytest.raises(Exception, match="a.csv.gz"):
        tree_digests(spark, [folder]).collect()


def test_bronze_rows_carry_the_tree_of_their_file(spark, tmp_lake):
    root = tmp_lake.removeprefix("file:") + "/landing/competencia=202302"
    os.makedirs(root)
    data = (";".join(R.RAW_COLUMNS) + "\r\n202302;SP;1;SÃO PAULO;c;1;N;10,00").encode("latin-1")
    with open(f"{root}/pagamentos 1.csv", "wb") as f:
        f.write(data)
    land = os.path.dirname(root)
    b = R.with_bronze_audit(spark, R.read_landing(spark, land), land, [(2023, 2)], file_hash="tree")
    tree = plain(data, 1 << 20, 1024, 3)
    assert [r["_file_hash"] for r in b.collect()] == [f"tree:{tree}:{len(data)}"]
