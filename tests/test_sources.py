"""Files on disk: CSV scans, versions, vault."""

import gzip

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows

from heatlane.sources import files, manifest, vault


@pytest.fixture()
def csv_dir(tmp_path):
    (tmp_path / "20240101.csv").write_text("race_id,rank,code\nr1,1,\nr1,nan,2\n", encoding="utf-8-sig")
    (tmp_path / "20240102.csv").write_text("code,race_id,extra\n5,r2,NA\n", encoding="utf-8")
    (tmp_path / "notes.txt").write_text("x")
    return str(tmp_path)


def test_scan_daily_csv_by_name(spark, csv_dir):
    out = files.scan_daily_csv(spark, csv_dir)
    assert rows(out, "race_id", "rank", "code", "extra", "__source_file") == [
        ("r1", "1", "", None, "20240101.csv"), ("r1", "nan", "2", None, "20240101.csv"), ("r2", None, "5", "NA", "20240102.csv"),
    ]
    some = files.scan_daily_csv(spark, csv_dir, ["code", "absent"])
    assert some.columns == ["code", "__source_file"]


def test_scan_csv_lenient(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("place,v\n桐生,1\n".encode())
    (tmp_path / "b.csv").write_bytes("place,v\n戸田,2\n".encode("cp932"))
    assert rows(files.scan_csv_lenient(spark, str(tmp_path)), "place", "v") == [("戸田", "2"), ("桐生", "1")]


def test_headers_in_other_orders_quotes_and_charsets(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes('place,"v,w"\nAAA,1\n'.encode("utf-8-sig"))
    (tmp_path / "b.csv").write_bytes('"v,w",place\n2,BBB\n"x,y","q""r"\n'.encode())
    (tmp_path / "c.csv").write_bytes('"v,w",place,場\n3,戸田ソ表,"予,約"\n'.encode("cp932"))
    got = files.scan_csv_lenient(spark, str(tmp_path)).select("place", "`v,w`", "場")
    assert rows(got) == sorted([("AAA", "1", None), ("BBB", "2", None), ('q"r', "x,y", None), ("戸田ソ表", "3", "予,約")], key=repr)
    assert rows(files.scan_daily_csv(spark, str(tmp_path)), "place") == [("AAA",), ("BBB",), ('q"r',), ("戸田ソ表",)]


def test_csv_sink_starts_with_a_mark(spark, tmp_path):
    files.write_csv(spark.createDataFrame([(1, "x")], "k int, t string").coalesce(1), str(tmp_path / "c"))
    (part,) = (tmp_path / "c").glob("*.csv")
    assert part.read_bytes() == b"\xef\xbb\xbfk,t\n1,x\n"
    assert rows(files.scan_daily_csv(spark, str(tmp_path / "c")), "k", "t") == [("1", "x")]


def test_versioned(spark, tmp_path):
    df = spark.createDataFrame([(1, 0.5)], "k int, p double")
    path = files.write_versioned(df, str(tmp_path), "tenji", "20240101", "20241231", {"m_strength": 200})
    assert path.endswith("build=20240101_20241231")
    got = files.read_latest(spark, str(tmp_path), "tenji").first()
    assert (got["p"], got["built_from"], got["m_strength"], got["version"]) == (0.5, "20240101", 200, "v1")


def test_a_failed_build_changes_nothing(spark, tmp_path):
    """A build that fails halfway, and one under way, are not seen; the committed one is read on."""
    df, root = spark.createDataFrame([(1, 0.5), (2, 0.25)], "k int, p double"), str(tmp_path)
    build = ("tenji", "20240101", "20241231", {"m_strength": 200})
    with pytest.raises(FileNotFoundError):
        files.read_latest(spark, root, "tenji")
    files.write_versioned(df, root, *build)
    before = files.read_latest(spark, root, "tenji")
    broken = spark.range(0, 100, 1, 10).select(F.col("id").cast("int").alias("k"), F.when(F.col("id") < 95, 0.1).otherwise(F.raise_error(F.lit("no"))).alias("p"))
    with pytest.raises(Exception, match="no"):
        files.write_versioned(broken, root, *build)
    assert rows(files.read_latest(spark, root, "tenji"), "k", "p") == [(1, 0.5), (2, 0.25)]
    files.write_versioned(df.limit(1), root, *build, "v2")
    assert files.read_latest(spark, root, "tenji").first()["version"] == "v2"
    assert rows(before, "k", "version") == [(1, "v1"), (2, "v1")]  # a reader that had begun goes on
    assert files.read_build(spark, root, *build[:3]).count() == 1
    assert not [p for p in (tmp_path / "tenji").iterdir() if p.name.startswith("latest.json.")]


def test_upsert_rewrites_only_the_buckets_it_touches(spark, tmp_path):
    schema, root = "rel_path string, mtime double, size long, sha256 string, date_ymd string", str(tmp_path)
    first = spark.createDataFrame([(f"p{i}", 1.0, i, "a", None) for i in range(500)] + [(None, 1.0, 0, "n", None)], schema)
    assert vault.store_index(first, root, 8) == list(range(8))
    files_of = lambda: {str(p): p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    before = files_of()
    assert vault.store_index(first.limit(0), root, 8) == []
    change = [("p7", 2.0, 1, "b", None), ("p7", 3.0, 1, "c", None), ("p7", 0.5, 1, "old", None)]
    (touched,) = vault.store_index(spark.createDataFrame(change, schema), root)
    after = files_of()
    assert all(after[p] == t for p, t in before.items())  # nothing is rewritten in place
    assert [p for p in after if p not in before] and all(f"__bucket={touched}/" in p for p in after if p not in before)
    got = manifest.read_buckets(spark, root)
    assert got.count() == 501 and rows(got.where("rel_path = 'p7'"), "mtime", "sha256") == [(3.0, "c")]
    with pytest.raises(ValueError, match="columns"):
        vault.store_index(first.drop("size"), root)
    assert manifest.read_buckets(spark, f"{root}/nothing") is None


def test_csv_and_parquet_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "優勝戦")], "k int, t string")
    files.write_csv(df, str(tmp_path / "c"), bom=False)
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).first()["t"] == "優勝戦"
    files.write_parquet(df, str(tmp_path / "p"))
    assert files.read_parquet(spark, str(tmp_path / "p")).first()["t"] == "優勝戦"


def test_sample_is_stable(spark, small):
    o = spark.read.parquet(f"{small}/orders.parquet")
    a = rows(files.sample_rows(o.repartition(3), ["o_orderkey"], 20), "o_orderkey")
    b = rows(files.sample_rows(o.repartition(9), ["o_orderkey"], 20), "o_orderkey")
    assert a == b and len(a) == 20


def test_vault_round_trip(spark, tmp_path):
    src = tmp_path / "src"
    (src / "x").mkdir(parents=True)
    (src / "x" / "pay20240101.bin").write_bytes(b"same")
    (src / "x" / "pay20240102.bin").write_bytes(b"same")
    (src / "odds20240103.bin").write_bytes(b"other")
    found = vault.scan_files(spark, str(src), "*.bin")
    objects, index = vault.vault_ingest(found, compress=True)
    assert objects.count() == 2 and index.count() == 3
    assert all(gzip.decompress(r["bytes"]) in (b"same", b"other") for r in objects.collect())
    assert rows(index, "rel_path", "date_ymd")[0] == ("odds20240103.bin", "20240103")
    counts = vault.ingest_counts(index).first()
    assert (counts["n_files"], counts["n_new"], counts["n_duplicate"]) == (3, 2, 1)
    out = tmp_path / "out"
    written = vault.vault_export(vault.vault_select(index, objects, "x/%"), str(out))
    assert rows(written) == [("x/pay20240101.bin", 4), ("x/pay20240102.bin", 4)]
    assert (out / "x" / "pay20240102.bin").read_bytes() == b"same"
    stored = objects.select("sha256").limit(1)
    assert vault.new_objects(objects, stored).count() == 1
    assert rows(vault.files_by_date(found, "20240102", None), "date_ymd") == [("20240102",), ("20240103",)]
    assert vault.day_grid(spark, "2024-02-27", "2024-03-01").count() == 4
