"""Files whose quoted values hold line breaks, cut into many byte ranges."""

import random

import pytest

from ledgerline.schemas import RAW_COLUMNS
from ledgerline.settings import Layout
from ledgerline.plans import pipeline as P
from ledgerline.sources import quoted as Q
from ledgerline.sources import raw_csv as R

HEADER = ";".join(RAW_COLUMNS)


@pytest.fixture()
def tiny_ranges(spark):
    """Splits of 64 bytes, so records run over the ends of ranges and some ranges lie inside one value."""
    conf = {"spark.sql.files.maxPartitionBytes": "64", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "4"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def land(root, period, name, text):
    import os

    d = root.removeprefix("file:") + f"/competencia={period}"
    os.makedirs(d, exist_ok=True)
    with open(f"{d}/{name}", "wb") as f:
        f.write(text.encode("latin-1"))


def rows_of(df):
    return sorted((tuple(r[c] for c in [*RAW_COLUMNS, R.PERIOD_DIR]) for r in df.collect()), key=repr)


def values(rng):
    """Plain, quoted, with separators, doubled and stray quotes, line breaks, empty."""
    word = "".join(rng.choice("aZé 19") for _ in range(rng.randrange(1, 9)))
    return rng.choice(
        [
            word, word, word, "", f'"{word}"', f'"{word};{word}"', f'"{word}""{word}"', f'"{word}\n{word}"', f'"\n\n{word};"""',
            f'"{word}\n""{word}"";\n{word}"', f'{word}"{word}', f'{word}" x "', '"' + "\n".join([word] * 30) + '"', '""', f'"{word}"tail',
        ]
    )


def test_equals_the_one_task_reader_over_many_ranges(spark, tmp_lake, tiny_ranges):
    root = tmp_lake + "/landing"
    rng = random.Random(11)
    for k in range(8):
        lines = ["202301;" + ";".join(["x" + values(rng) if rng.random() < 0.2 else values(rng) for _ in RAW_COLUMNS[1:]]) for _ in range(rng.randrange(1, 12))]
        end = rng.choice(["", "\n"])
        land(root, f"20230{k % 3 + 1}", f"f{k}.csv", HEADER + "\n" + "\n".join(lines) + end)
    got = R.read_landing(spark, root)
    want = R.read_landing(spark, root, multi_line=True)
    assert rows_of(got) == rows_of(want)
    assert any("\n" in (v or "") for r in rows_of(got) for v in r if isinstance(v, str))


def test_windows_line_ends_and_blank_lines(spark, tmp_lake, tiny_ranges):
    root = tmp_lake + "/landing"
    rows = ['202301;SP;1;"SAO\r\nPAULO";c;1;"N ""x""";10,00', "", "202301;RJ;2;RIO;c;2;N;20,00", ""]
    land(root, "202301", "a.csv", HEADER + "\r\n" + "\r\n".join(rows))
    got = {r["NIS_FAVORECIDO"]: r for r in R.read_landing(spark, root).collect()}
    assert len(got) == 2 and got["1"]["NOME_MUNICIPIO"] == "SAO\nPAULO" and got["1"]["VALOR_PARCELA"] == "10,00"
    assert got["1"]["NOME_FAVORECIDO"] == 'N "x"'


def test_layouts_with_and_without_breaks(spark, tmp_lake, tiny_ranges):
    root = tmp_lake + "/landing"
    land(root, "202301", "a.csv", HEADER + '\n202301;SP;1;"S\nP";c;1;ANA;10,00\n')
    land(root, "202302", "b.csv", ";".join(reversed(RAW_COLUMNS)) + ';LOTE\n20,00;"BI\n\nA";2;d;B;2;RJ;202302;"l;\n1"\n')
    land(root, "202302", "c.csv", "LOTE;" + HEADER + "\nx;202302;PR;3;C;e;3;CAIO;30,00\n")
    got = {r["UF"]: r for r in R.read_landing(spark, root).collect()}
    assert got["SP"]["NOME_MUNICIPIO"] == "S\nP" and got["SP"]["LOTE"] is None
    assert got["RJ"]["NOME_FAVORECIDO"] == "BI\n\nA" and got["RJ"]["LOTE"] == "l;\n1" and got["RJ"]["VALOR_PARCELA"] == "20,00"
    assert got["PR"]["LOTE"] == "x" and got["PR"]["NOME_FAVORECIDO"] == "CAIO" and got["PR"][R.PERIOD_DIR] == 202302


def test_range_states(spark, tmp_lake, tiny_ranges):
    root = tmp_lake + "/landing"
    body = '"' + "a" * 70 + "\n" + "b" * 150 + '\n";1\n' + "c" * 70 + "\n"
    land(root, "202301", "a.csv", body)
    lines = Q.read_lines(spark, [root + "/competencia=202301"], "p")
    got = {r["start"]: (r["inside"], r["owner"]) for r in Q.range_states(lines, "p").collect()}
    # ranges that a line begins in: the first, that of the b, that of the closing line and the c
    assert got == {0: (False, None), 64: (True, 0), 192: (True, 0)}


def test_no_payment_is_lost_by_default(spark, tmp_lake):
    lay = Layout(root=tmp_lake)
    land(lay.landing, "202104", "a.csv", HEADER + '\n202104;PR;1;CURITIBA;c;1;"MARIA\nSILVA";10,00\n202104;PR;1;CURITIBA;c;2;"IVO";20,00\n')
    result = P.run(spark, lay, [(2021, 4)], layers=("bronze", "silver"))
    assert result["layers"]["bronze"]["rows"] == 2 and result["layers"]["silver"]["rows"] == 2


def test_quote_that_never_closes_names_the_file(spark, tmp_lake):
    root = tmp_lake + "/landing"
    land(root, "202301", "open.csv", HEADER + '\n202301;SP;1;"' + "\n".join(["x" * 50] * 40))
    lines = Q.read_lines(spark, [root + "/competencia=202301"], "p")
    with pytest.raises(Exception, match="open.csv has a quote that is not closed within 500 bytes"):
        Q.read_records(lines, "p", "ISO-8859-1", limit=500).collect()


def test_headers_of_many_files_come_from_one_job(spark, tmp_lake):
    root = tmp_lake + "/landing"
    for k in range(400):
        columns = RAW_COLUMNS if k % 2 else [*reversed(RAW_COLUMNS), "LOTE"]
        at = {"MES_COMPETENCIA": "202301", "NIS_FAVORECIDO": str(k), "LOTE": "l"}
        land(root, "202301", f"f{k}.csv", ";".join(columns) + "\n" + ";".join(at.get(c, "v") for c in columns) + "\n")
    df = R.read_landing(spark, root)
    rows = df.select("NIS_FAVORECIDO", "MES_COMPETENCIA", "LOTE").collect()
    assert sorted(int(r[0]) for r in rows) == list(range(400))
    assert all(r[1] == "202301" and r[2] == (None if int(r[0]) % 2 else "l") for r in rows)
