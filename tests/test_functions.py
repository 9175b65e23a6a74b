import random
import re
import unicodedata

import pandas as pd
from pyspark.sql import functions as F

from everkey.functions import keys, records, text
from everkey.functions.slices import SLICE, number_rows, sliced
from everkey.operators.history import history_from_observations
import build as b


def clean(value):
    """The rule for clean text, said in plain Python."""
    if value is None:
        return None
    lines = [line.rstrip() for line in re.split("\r\n|\r|\n", unicodedata.normalize("NFC", value))]
    return "\n".join(line for line in "\n".join(lines).strip().split("\n") if line)


def test_canon_text_on_spoilt_strings(spark):
    random.seed(7)
    alphabet = "aé \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0   　éÅ가\U0001F600b"
    values = ["".join(random.choices(alphabet, k=random.randint(0, 14))) for _ in range(8000)] + [None, "", " \n "]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    found = {r.i: r.c for r in df.select("i", text.canon_text(F.col("v")).alias("c")).collect()}
    assert [(v, found[i], clean(v)) for i, v in enumerate(values) if found[i] != clean(v)] == []


def test_keys_and_ids(spark):
    shapes = ["004-witch-b-s", "001-a-b-c-d", "12-x-box_topper-f", "no key", "001-x-B-s", "1-٣-b-s", "٣-x-b-s", None]
    df = spark.createDataFrame([(s,) for s in shapes], "k string")
    got = [tuple(r) for r in df.select(*[keys.key_part(F.col("k"), p) for p in keys.KEY_PARTS]).collect()]
    assert got == [
        ("004", "witch", "b", "s"), ("001", "a-b", "c", "d"), ("12", "x", "box_topper", "f"), (None,) * 4, (None,) * 4,
        ("1", "٣", "b", "s"), ("٣", "x", "b", "s"), (None,) * 4]

    ids = spark.createDataFrame([(s,) for s in ["C000042", "p42", "000042", "1234567", "X1", "", "C", None]], "s string")
    got = ids.select(keys.normal_entity_ref(F.col("s")), keys.normal_variant_ref(F.col("s")), keys.id_number(F.col("s"))).collect()
    assert [tuple(r) for r in got] == [
        ("C000042", "P000042", 42), ("C000042", "P000042", 42), ("C000042", "P000042", 42),
        ("C1234567", "P1234567", 1234567)] + [(None, None, None)] * 4


def test_search_predicates(spark):
    df = spark.createDataFrame([
        ("006", "Gothic", "Box_Topper", "Fire, Air", "100% Wild_Card"), ("001", "Alpha", None, None, None)],
        "set_number string, set_name string, product string, elements string, name string")

    def holds(column):
        return [r[0] for r in df.select(column).collect()]

    number, name = F.col("set_number"), F.col("set_name")
    for wanted in ("6", "06", "006", "gothic", " GOTHIC "):
        assert holds(text.in_wanted_set(number, name, wanted)) == [True, False], wanted
    assert holds(text.in_wanted_set(number, name, "0006")) == [False, False]
    assert holds(text.same_product(F.col("product"), " box topper")) == [True, False]
    assert holds(text.has_text(F.col("elements"), "AIR")) == [True, False]
    assert holds(text.has_text(F.col("name"), "%")) == [True, False]
    assert holds(text.has_text(F.col("name"), "d_c")) == [True, False]
    assert holds(text.has_text(F.col("name"), "_w")) == [False, False]
    assert holds(text.same_text(F.col("product"), "")) == [False, True]
    assert holds(text.is_errata(F.col("name"))) == [False, False]


def many_slices(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "7")


def as_before(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_numbers_run_through_all_slices(spark):
    many_slices(spark)
    try:
        df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("a"), (F.col("id") % 3).alias("b"))
        assert sliced(df, ["a"], "t").select(SLICE).distinct().count() > 1
        got = number_rows(df, ["b", "a"], "n", start=11).collect()
    finally:
        as_before(spark)
    want = {key: n for n, key in enumerate(sorted((r.b, r.a) for r in got), 11)}
    assert len(want) == 1000 and all(want[(r.b, r.a)] == r.n for r in got)
    assert number_rows(df.where("a < 0"), ["a"], "n").count() == 0


def test_history_of_a_hot_id_spans_slices(spark):
    random.seed(5)
    seen = []
    for n in range(1500):
        who = 1 if n % 3 == 0 else random.randint(2, 40)
        key = random.choice(["a", "a", "a", "b", None]) if n % 400 < 300 else "a"
        seen.append((who, key, n // 2, n))
    many_slices(spark)
    try:
        df = spark.createDataFrame(seen, "who bigint, key string, at bigint, n bigint")
        got = [tuple(r) for r in history_from_observations(df, "who", "key", "at", "n").collect()]
    finally:
        as_before(spark)
    want = []
    for who, rows in pd.DataFrame(seen, columns=["who", "key", "at", "n"]).groupby("who"):
        runs = []
        for row in rows.sort_values(["at", "n"]).itertuples():
            key = row.key if isinstance(row.key, str) else None
            if not runs or runs[-1][1] != key:
                runs.append((who, key, row.at))
        ends = [r[2] for r in runs[1:]] + [None]
        want += [(w, k, a, e) for (w, k, a), e in zip(runs, ends)]
    order = lambda t: tuple((v is not None, str(v)) for v in t)
    assert sorted(got, key=order) == sorted(want, key=order)


def test_closing_matches_the_open_row_of_the_old_key(spark):
    from everkey.operators.history import close_and_open
    from everkey.schemas import KEY_HISTORY

    history = spark.createDataFrame([
        ("a", 1, "2024-01-01", "2024-02-01"), ("b", 1, "2024-02-01", None), ("c", 2, "2024-01-01", None)], KEY_HISTORY)
    renames = spark.createDataFrame([(1, "b", "a")], "variant_id bigint, old_key string, new_key string")
    opened = spark.createDataFrame([(3, "d")], "variant_id bigint, slug string")
    after = close_and_open(history, renames, opened, "variant_id", "slug", "2024-03-01")
    assert b.rows(after) == sorted([
        ("a", 1, "2024-01-01", "2024-02-01"), ("a", 1, "2024-03-01", None), ("b", 1, "2024-02-01", "2024-03-01"),
        ("c", 2, "2024-01-01", None), ("d", 3, "2024-03-01", None)], key=lambda t: tuple((v is not None, str(v)) for v in t))


def test_packed_records_lose_nothing(spark):
    """Null, empty texts and the marks themselves come back, and equal texts mean equal records."""
    values = [None, "", "a", "\x1f", "\x1b", "\x1b0", "\x1b1", "\x1b2", "a\x1fb", "\x1b\x1f\x1b1", "null", "\\"]
    rows = [(a, b, n) for a in values for b in values for n in (None, -7)]
    df = spark.createDataFrame(rows, "a string, b string, n int")
    packed = df.select("*", records.packed(df.columns).alias("packed")).select("*", records.parts("packed").alias("parts"))
    found = packed.select("packed", *records.unpacked("parts", df.columns, dict(df.dtypes)).values())
    assert found.select(df.columns).dtypes == df.dtypes
    back = [tuple(r) for r in found.collect()]
    assert [r[1:] for r in back] == rows and len({r[0] for r in back}) == len(rows)


def test_numbered_rows_are_widened_after_they_are_dealt_out(spark):
    """The columns that ``widen`` adds are written, and take no part in the shuffle."""
    names = spark.createDataFrame([(k, f"name {k}") for k in range(5)], "a bigint, name string")
    numbered = number_rows(spark.range(5).select((4 - F.col("id")).alias("a")), ["a"], "n", widen=lambda rows: rows.join(F.broadcast(names), "a"))
    assert sorted((r.a, r.n, r.name) for r in numbered.collect()) == [(k, k + 1, f"name {k}") for k in range(5)]
