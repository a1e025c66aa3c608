import pytest
from pyspark.sql import functions as F

from gridspark.sources import pages


def table(spark):
    """3,000 rows; the value repeats and is missing at times."""
    value = F.when(F.col("id") % 11 != 0, (F.col("id") * 37 % 500).cast("double"))
    return spark.range(3000).select("id", value.alias("value"))


def key():
    return [pages.falling(F.col("value")), F.col("id")]


def offset_page(spark, number, limit, where="true"):
    rows = table(spark).filter(where).orderBy(F.desc_nulls_last("value"), "id")
    return [tuple(r) for r in rows.offset((number - 1) * limit).limit(limit).collect()]


def test_pages_equal_offsets_and_read_few_files(spark, tmp_path):
    out = str(tmp_path / "p")
    pages.write_pages(table(spark), out, key(), file_rows=100)
    assert len(list((tmp_path / "p").glob("*.parquet"))) == 30
    after, read = None, []
    for number in range(1, 33):
        page = pages.read_page(spark, out, 97, after)
        assert [tuple(r) for r in page.rows.collect()] == offset_page(spark, number, 97)
        after, read = page.after, [*read, page.files]
    # the first page as the thirtieth, and nothing behind the last
    assert max(read) <= 3 and read[0] <= 2 and read[-1] == 0


def test_a_late_page_leaves_other_files_alone(spark, tmp_path):
    out = tmp_path / "p"
    pages.write_pages(table(spark), str(out), [F.col("id")], file_rows=100)
    first = pages.read_page(spark, str(out), 2050)
    index = spark.read.parquet(f"{out}/{pages.INDEX}").orderBy("first").collect()
    for row in index[:20] + index[24:]:
        name = row["file"].rsplit("/", 1)[1]
        data = (out / name).read_bytes()
        # the footer stays readable, the rows do not
        (out / name).write_bytes(b"PAR1" + b"\0" * 300 + data[304:])
        (out / f".{name}.crc").unlink()
    with pytest.raises(Exception):
        pages.read_page(spark, str(out), 50)
    page = pages.read_page(spark, str(out), 50, first.after)
    assert [r["id"] for r in page.rows.collect()] == list(range(2050, 2100)) and page.files <= 2


@pytest.mark.parametrize("where", ["id % 400 = 3", "value IS NULL", "id < 0"])
def test_filtered_pages(spark, tmp_path, where):
    out = str(tmp_path / "p")
    pages.write_pages(table(spark), out, key(), file_rows=100)
    after, got = None, []
    for _ in range(100):
        page = pages.read_page(spark, out, 5 if where.startswith("id") else 100, after, F.expr(where))
        rows = page.rows.collect()
        if not rows:
            break
        got, after = got + [tuple(r) for r in rows], page.after
    assert got == offset_page(spark, 1, 3000, where)


def test_an_empty_table(spark, tmp_path):
    out = str(tmp_path / "p")
    pages.write_pages(table(spark).limit(0), out, key())
    page = pages.read_page(spark, out, 10)
    assert page.rows.collect() == [] and page.files == 0


def test_many_files_are_written_by_few_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(pages, "TASK_ROWS", 1000)
    out = tmp_path / "p"
    pages.write_pages(table(spark), str(out), key(), file_rows=50)
    # A file's name begins with the number of the task that wrote it.
    names = [f.name for f in out.glob("*.parquet")]
    assert len(names) >= 60 and len({n.split("-")[1] for n in names}) == 3
    after, rows = None, []
    while len(rows) < 3000:
        page = pages.read_page(spark, str(out), 700, after)
        rows, after = rows + [tuple(r) for r in page.rows.collect()], page.after
    assert rows == offset_page(spark, 1, 3000)
