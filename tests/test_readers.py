"""Files that a reader must refuse or read by name."""

from __future__ import annotations

import json

import pytest

from salescope.schema import REQUIRED_COLUMNS
from salescope.sources.readers import scan_sales
from salescope_checks import load_queries

HEADERS = [c.replace("_", " ").title() for c in REQUIRED_COLUMNS]
NUMBERS = {"year": 2020, "engine_size_l": 2.0, "mileage_km": 100.0, "price_usd": 7.0, "sales_volume": 3.0}
VALUES = [NUMBERS.get(c, "x") for c in REQUIRED_COLUMNS]


def csv(path, names, values):
    path.write_text(",".join(names) + "\n" + ",".join("" if v is None else str(v) for v in values) + "\n")


def lines(path, *records):
    path.write_text("\n".join(json.dumps(r) for r in records) + "\n")


def test_json_with_display_headers_reads_as_csv_does(spark, tmp_path):
    csv(tmp_path / "a.csv", HEADERS, VALUES)
    lines(tmp_path / "a.json", dict(zip(HEADERS, VALUES)))
    one = scan_sales(spark, str(tmp_path / "a.csv")).select(*REQUIRED_COLUMNS).collect()
    two = scan_sales(spark, str(tmp_path / "a.json")).select(*REQUIRED_COLUMNS).collect()
    assert one == two and one[0].price_usd == 7.0


def test_json_without_a_column_is_refused(spark, tmp_path):
    record = dict(zip(HEADERS, VALUES))
    record.pop("Region")
    lines(tmp_path / "a.json", record)
    with pytest.raises(ValueError, match="region"):
        scan_sales(spark, str(tmp_path / "a.json"))


def test_csv_folder_with_other_column_order_is_refused(spark, tmp_path):
    folder = tmp_path / "sales.csv"
    folder.mkdir()
    csv(folder / "1.csv", HEADERS, VALUES)
    csv(folder / "2.csv", HEADERS[::-1], VALUES[::-1])
    with pytest.raises(Exception, match="header|schema"):
        scan_sales(spark, str(folder)).collect()


def test_undeclared_numbers_are_numbers(spark, tmp_path):
    folder = tmp_path / "sales.csv"
    folder.mkdir()
    csv(folder / "1.csv", [*HEADERS, "Extra", "Note"], [*VALUES, 1.5, "1a"])
    csv(folder / "2.csv", [*HEADERS, "Extra", "Note"], [*VALUES, None, "2"])
    types = dict(scan_sales(spark, str(folder)).dtypes)
    assert types["extra"] == "double" and types["note"] == "string"


def test_undeclared_numbers_keep_every_digit(spark, tmp_path):
    folder = tmp_path / "sales.csv"
    folder.mkdir()
    names = [*HEADERS, "Serial", "Huge", "Code", "Share", "Mixed"]
    csv(folder / "1.csv", names, [*VALUES, 9007199254740993, 10**25 + 1, "007", "0.5", 4])
    csv(folder / "2.csv", names, [*VALUES, -1, 3, "12", "1e3", "0.25"])
    df = scan_sales(spark, str(folder))
    types = dict(df.dtypes)
    assert [types[c] for c in ("serial", "huge", "code", "share", "mixed")] == [
        "bigint", "decimal(38,0)", "string", "double", "double"
    ]
    assert {r.serial for r in df.collect()} == {9007199254740993, -1}
    assert {int(r.huge) for r in df.collect()} == {10**25 + 1, 3}
    lines(tmp_path / "a.json", {**dict(zip(HEADERS, VALUES)), "Serial": 9007199254740993})
    assert scan_sales(spark, str(tmp_path / "a.json")).first().serial == 9007199254740993


@pytest.fixture
def copies(tmp_path, monkeypatch):
    """A folder of its own for the copies that are dispatched."""
    monkeypatch.setattr(load_queries, "new_path", lambda spark, name: f"file:{tmp_path}/{name}-{len(list(tmp_path.iterdir()))}")
    return tmp_path


def test_dispatch_packs_its_text_and_keeps_one_copy_at_a_time(spark, make, copies, monkeypatch):
    rows = [{"model": f"M{i % 3}", "price_usd": float(i)} for i in range(997)]
    table = make(*rows, {"model": None}, {"region": None, "sales_volume": None}, {}, sales_volume=4.0).coalesce(2)
    monkeypatch.setattr(load_queries, "sales_fact", lambda spark, sf_dir: table)
    seen = {}

    def read(spark, path):
        (copy,) = copies.iterdir()
        assert path == f"file:{copy}"
        seen[copy.suffix] = [(f.name, f.stat().st_size) for f in copy.iterdir() if f.name.startswith("part-")]
        return scan_sales(spark, path)

    monkeypatch.setattr(load_queries, "scan_sales", read)
    for options in load_queries.COPIES.values():
        monkeypatch.setitem(options, "maxRecordsPerFile", 400)
    found = load_queries._dispatch(spark, "")
    assert not list(copies.iterdir())
    assert sorted(map(tuple, found.collect())) == [(fmt, 999, 3996) for fmt in ("csv", "json", "parquet")]
    for fmt, plain in ((".CSV", 50_000), (".JSON", 180_000)):  # about as many bytes as plain text
        assert len(seen[fmt]) == 4 and all(name.endswith(f"{fmt.lower()}.lz4") for name, _ in seen[fmt])
        assert sum(size for _, size in seen[fmt]) * 2 < plain


def test_dispatch_that_fails_leaves_no_copy(spark, make, copies, monkeypatch):
    monkeypatch.setattr(load_queries, "sales_fact", lambda spark, sf_dir: make({}, {}))
    monkeypatch.setattr(load_queries, "scan_sales", lambda spark, path: scan_sales(spark, path, required=["absent"]))
    with pytest.raises(ValueError, match="absent"):
        load_queries._dispatch(spark, "")
    assert not list(copies.iterdir())
