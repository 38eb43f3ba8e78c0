"""Mode imputation, the strict dictionary join, block digests and manifests, value lists of long columns."""

import hashlib

import pytest
from pyspark.sql import functions as F

from tabulon.operators import dictionary as N
from tabulon.operators import profile as B
from tabulon.operators.clean import processed_schema
from tabulon.operators.impute import ModeImputer, ModeImputerModel
from tabulon.session import materialize
from tabulon.sources import fingerprint


def test_mode_imputer(spark, tmp_path):
    df = spark.createDataFrame([("a", "x"), ("b", "x"), ("a", None), ("b", ""), (None, "y"), ("", "x")], "f string, g string")
    fitted = ModeImputer(inputCols=["f", "g"], outputCols=["f2", "g2"], blanks=[""]).fit(df)
    assert fitted.getModes() == {"f": "a", "g": "x"}  # of equally frequent values the smallest
    assert [tuple(r) for r in fitted.transform(df).select("f2", "g2").collect()] == [("a", "x"), ("b", "x"), ("a", "x"), ("b", "x"), ("a", "y"), ("a", "x")]
    fitted.write().save(str(tmp_path / "m"))
    again = ModeImputerModel.load(str(tmp_path / "m"))
    assert again.getModes() == fitted.getModes() and again.transform(df).collect() == fitted.transform(df).collect()
    assert ModeImputer(inputCols=["f"], outputCols=["o"]).fit(df).getModes() == {"f": "a"}  # without blanks, '' is a value of its own
    with pytest.raises(ValueError, match="no value"):
        ModeImputer(inputCols=["g"], outputCols=["o"], blanks=["", "x", "y"]).fit(df)


def test_strict_parts(spark):
    one = spark.createDataFrame([("a", 1), ("b", 2)], "variable string, p int")
    two = spark.createDataFrame([("b", 4), ("a", 3)], "variable string, q int")
    assert sorted(tuple(r) for r in N.strict_parts({"one": one, "two": two}).collect()) == [("a", 1, 3), ("b", 2, 4)]
    for parts, said in (({"one": one, "two": two.limit(1)}, "a is missing from two"), ({"one": one.limit(1), "two": two}, "b is missing from one")):
        with pytest.raises(Exception, match=said):
            N.strict_parts(parts).collect()


def test_large_files_are_hashed_in_blocks(spark, tmp_path):
    """A file above the size of a row: its holes take no disk."""
    big = tmp_path / "big.bin"
    with big.open("wb") as f:
        f.write(b"start")
        f.truncate((2 << 30) + 12345)
    digest, block = hashlib.sha256(b"start" + bytes((1 << 20) - 5)), bytes(1 << 20)
    for _ in range(2047):
        digest.update(block)
    digest.update(bytes(12345))
    r = fingerprint.file_fingerprints(spark, str(big)).first()
    assert (r.bytes, r.sha256) == ((2 << 30) + 12345, digest.hexdigest())
    pinned = fingerprint.assert_pinned(fingerprint.file_fingerprints(spark, str(big)), r.sha256, "sha256")
    assert pinned.count() == 1
    big.write_bytes(b"other")
    with pytest.raises(Exception, match="sha256 changed"):
        fingerprint.assert_pinned(fingerprint.file_fingerprints(spark, str(big)), r.sha256, "sha256").collect()


def test_manifests(spark, tmp_path):
    root = tmp_path / "model"
    (root / "deep").mkdir(parents=True)
    for name, text in (("a", "1"), ("b", "2"), ("deep/c", "3"), ("_SUCCESS", "")):
        (root / name).write_text(text)
    before = materialize(fingerprint.manifest(spark, str(root)))
    assert sorted(r.file for r in before.collect()) == ["a", "b", "deep/c"]
    (root / "b").write_text("changed")
    (root / "d").write_text("new")
    (root / "a").unlink()
    after = fingerprint.manifest(spark, str(root))
    assert {r.file: r.change for r in fingerprint.manifest_diff(before, after).collect()} == {"a": "removed", "b": "changed", "deep/c": "same", "d": "added"}


def test_long_columns_are_never_listed(spark):
    vf = spark.createDataFrame([("long", f"v{i}", 1) for i in range(30)] + [("short", "1", 5), ("short", "0", 2), ("short", "", 9)], "column string, value string, n long")
    got = {r["column"]: r.vals for r in B.value_lists(vf, ["long", "short"], most=10).collect()}
    assert got == {"long": None, "short": ["0", "1"]}
    df = spark.createDataFrame([(f"k{i}", "x" if i % 2 else "y") for i in range(1200)], "id string, s string")
    out = {r["column"]: r for r in processed_schema(df).collect()}
    assert out["id"].categories is None and out["id"].distinct_count == 1200 and out["s"].categories == "x|y"


def test_observed_digest_tells_counts_apart(spark):
    vf = lambda n: spark.createDataFrame([("c", "a", n), ("c", "b", 2)], "column string, value string, n long")
    one, two = (N.observed_counts(vf(n)).first() for n in (1, 3))
    assert one.observed_values == two.observed_values == 2 and one.observed_digest != two.observed_digest


def test_special_codes(spark):
    codes = [("1", "Yes"), ("8", "Don't know"), ("9", "Refused"), ("0", "No/DK/Ref")]
    df = spark.createDataFrame([(codes,)], "codes array<struct<value:string,label:string>>")
    assert df.select(N.special_codes(F.col("codes"))).first()[0] == "8;9;0"
