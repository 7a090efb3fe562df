"""Dump files: discovery, path forms, odd rows, and both cleaning profiles."""

import gzip
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from clickweir.operators.cleaning import clean
from clickweir.operators.quality import cleaning_counts
from clickweir.sources import bronze

ODD_ROWS = [
    "A\tB\tlink\t5",
    "A\tB\tlink\t7",
    "other-search\tFoo_Bar\texternal\t10",
    '"Heroes"_(x)\t"Heroes"_(album)\tlink\t9',
    '"Weird_Al"\t"Q"\tlink\t4',
    "A\tB",
    "A\tB\tlink\tabc",
    "A\tB\tlink\t12.7",
    "A\tD\tlink\t99999999999",
    "A\tE\tother\t 5",
    "A\tB\tlink\t4\textra",
    "A\tB\tlink\t4\t",
    "\tC\tother\t6",
    "A\t\tlink\t3",
    "A\tA\tlink\t8",
    "A_\tA\tlink\t8",
    "A\tSpecial:X\tlink\t8",
    "A\tError_404_x\tlink\t8",
    "A\tB\tLINK\t2",
    "A\tD\tlink\t0",
    "prev\tcurr_id\ttype\tn",
    "#hash\tBack\\slash\tlink\t3",
]


def dump(root: Path, name: str, rows: list[str]) -> None:
    path = root / name
    path.parent.mkdir(parents=True, exist_ok=True)
    data = "".join(row + "\n" for row in rows).encode()
    path.write_bytes(gzip.compress(data) if name.endswith(".gz") else data)


@pytest.fixture()
def root():
    return Path(tempfile.mkdtemp(prefix="bronze-", dir="/tmp"))


def by_text(rows):
    return sorted(rows, key=repr)


def values(df, *columns):
    return by_text(tuple(r) for r in df.select(*columns).collect())


@pytest.fixture()
def odd(spark, root):
    dump(root, "2024-09/clickstream-eswiki-2024-09.tsv.gz", ODD_ROWS)
    return bronze.read_dumps(spark, str(root))


def test_scan_keeps_rows_as_text(odd):
    rows = odd.collect()
    assert {(r.lang, r.year, r.month) for r in rows} == {("es", 2024, 9)}
    assert len(rows) == len(ODD_ROWS) - 2  # the two rows with five fields
    assert ('"Weird_Al"', '"Q"', "link", "4") in values(odd, "prev", "curr", "type", "n")
    assert ("#hash", "Back\\slash", "link", "3") in values(odd, "prev", "curr", "type", "n")
    assert [r.curr for r in rows if r.prev is None] == ["C"]
    assert sum(r.curr is None for r in rows) == 1
    assert sum(r.type is None and r.n is None for r in rows) == 1
    assert odd.count() == len(rows)
    assert odd.select("lang").count() == len(rows)


def test_strict_profile(odd):
    assert values(clean(odd, "strict"), "prev_title", "curr_title", "type", "n") == by_text([
        ("A", "B", "link", 7),
        ("other-search", "Foo Bar", "external", 10),
        ('"Heroes" (x)', '"Heroes" (album)', "link", 9),
        ('"Weird Al"', '"Q"', "link", 4),
        ("A", "E", "other", 5),
        ("A", "A", "link", 8),
        ("#hash", "Back\\slash", "link", 3),
    ])


def test_lenient_profile(odd):
    assert values(clean(odd, "lenient"), "prev_title", "curr_title", "type", "n") == by_text([
        ("A", "B", "link", 5),
        ("A", "B", "link", 7),
        ("other-search", "Foo_Bar", "external", 10),
        ('"Heroes"_(x)', '"Heroes"_(album)', "link", 9),
        ('"Weird_Al"', '"Q"', "link", 4),
        ("A", "E", "other", 5),
        ("A", "A", "link", 8),
        ("A_", "A", "link", 8),
        ("A", "Special:X", "link", 8),
        ("A", "Error_404_x", "link", 8),
        ("#hash", "Back\\slash", "link", 3),
    ])


def test_noise_lists_are_parameters(odd):
    kept = clean(odd, "strict", prefixes=["Foo"], fragments=["Heroes"])
    titles = {r.curr_title for r in kept.collect()}
    assert "Special:X" in titles and "Error 404 x" in titles
    assert "Foo Bar" not in titles and '"Heroes" (album)' not in titles


def test_unknown_profile_is_refused(odd):
    with pytest.raises(ValueError):
        clean(odd, "other")


def test_cleaning_counts(odd):
    strict = cleaning_counts(odd, "strict").collect()[0]
    assert (strict.rows_clean, strict.is_empty) == (8, False)
    assert strict.rows_read - strict.rows_clean == strict.rows_filtered
    lenient = cleaning_counts(odd, "lenient").collect()[0]
    assert lenient.rows_clean == clean(odd, "lenient").count()


def test_partition_without_valid_rows_is_marked(spark, root):
    dump(root, "2024-09/clickstream-eswiki-2024-09.tsv.gz", ["A\tB\tlink\t0"])
    counts = cleaning_counts(bronze.read_dumps(spark, str(root))).collect()
    assert [(c.rows_read, c.is_empty) for c in counts] == [(0, True)]


def test_path_forms(spark, root):
    row = ["A\tB\tlink\t1"]
    for name in (
        "2024-09/clickstream-eswiki-2024-09.tsv",
        "misc/clickstream-enwiki-2023-01.tsv",
        "misc/clickstream-de-2023-02.tsv",
        "bad-dir/clickstream-eswiki-2024-09.tsv",
        "2024-09/other.tsv",
    ):
        dump(root, name, row)
    strict = bronze.read_dumps(spark, str(root))
    assert values(strict, "lang", "year", "month") == [("de", 2023, 2), ("en", 2023, 1), ("es", 2024, 9)]
    lenient = bronze.read_dumps(spark, str(root), allow_name_form=False)
    assert values(lenient, "lang", "year", "month") == [("es", 2024, 9)]
    files = bronze.with_partition(bronze.discover(spark, str(root)))
    rejected = {r.path.rsplit("/", 2)[1] for r in files.filter(~F.col("accepted")).collect()}
    assert rejected == {"bad-dir", "2024-09"}


def test_plain_files_are_ignored_beside_packed_ones(spark, root):
    dump(root, "2024-09/clickstream-eswiki-2024-09.tsv.gz", ["A\tB\tlink\t1"])
    dump(root, "2024-09/clickstream-enwiki-2024-09.tsv", ["A\tB\tlink\t1"])
    assert values(bronze.read_dumps(spark, str(root)), "lang") == [("es",)]


def test_last_file_of_a_partition_wins(spark, root):
    dump(root, "2024-09/clickstream-eswiki-2024-09.tsv.gz", ["A\tOld\tlink\t1"])
    dump(root, "late/clickstream-eswiki-2024-09.tsv.gz", ["A\tNew\tlink\t1"])
    assert values(bronze.read_dumps(spark, str(root)), "curr") == [("New",)]


def test_selection_and_limit(spark, root):
    for lang in ("de", "en", "es"):
        for month in ("2024-08", "2024-09"):
            dump(root, f"{month}/clickstream-{lang}wiki-{month}.tsv.gz", ["A\tB\tlink\t1"])

    def read(**options):
        return values(bronze.read_dumps(spark, str(root), **options), "lang", "month")

    assert len(read()) == 6
    assert read(lang="en") == [("en", 8), ("en", 9)]
    assert read(year=2024, month=9, lang="es") == [("es", 9)]
    assert read(limit=2) == [("de", 8), ("en", 8)]
    assert read(year=1999) == []


def test_empty_folder(spark, root):
    assert bronze.read_dumps(spark, str(root)).count() == 0
