import random
import re

from pyspark.sql import functions as F

from placeweave.functions import text
from placeweave.plans.observations import COUNTY_RULES, clean_county_name, recode_by_rules, recode_by_table


def lit(value):
    return F.lit(value).cast("string")


def test_glue_is_missing_when_a_part_is(one):
    assert one(text.glue(lit("a"), lit("b"), sep="_")) == "a_b"
    assert one(text.glue(lit("a"), lit(None), sep="_")) is None
    assert one(text.glue(lit("a"), lit("b"), lit("c"))) == "abc"


def test_unite_writes_missing_as_text(one):
    assert one(text.unite(lit(None), lit("EC Yes"), sep=": ")) == "NA: EC Yes"


def test_only_the_first_word_is_dropped(one):
    assert one(text.drop_first_word(lit("county county x"), "county")) == " county x"
    assert one(text.drop_first_word(lit("countywide county"), "county")) == "countywide "


def test_whitespace(one):
    assert one(text.trim_all(lit("\t a  b "))) == "a  b"
    assert one(text.squeeze_spaces(lit("a  b\t\tc d"))) == "a b c d"


def test_padding_never_truncates(one):
    assert one(*[text.pad_left(lit(v), 5) for v in ("4001", "04001", "123456")]) == ("04001", "04001", "123456")
    assert one(text.pad_right(lit("4001"), 5), text.pad_right(lit("123456"), 5)) == ("40010", "123456")


def test_prefix_is_missing_for_short_or_lettered_keys(one):
    assert one(*[text.geoid_prefix(lit(v)) for v in ("26163031102", "2616303", "T26163031102", None)]) == (
        "261630311", None, None, None)


def test_numbers_in_text(one):
    values = ["+32.47", "-086.49", "1,234.5 MW", "none", None]
    assert one(*[text.number_in_text(lit(v)) for v in values]) == (32.47, -86.49, 1234.5, None, None)


def test_bad_integers_are_missing(one):
    assert one(*[text.text_to_int(lit(v)) for v in ("2010", "n/a", "12.5")]) == (2010, None, None)


def test_rounding_is_half_to_even(one):
    assert one(*[text.round_even(F.lit(v)) for v in (0.5, 1.5, 2.5, -0.5)]) == (0.0, 2.0, 2.0, 0.0)


def test_random_text_against_python(spark):
    rng = random.Random(2)
    pieces = ["county", "County", "area", "parish", "(part)", "(", ")", " ", "  ", "\t", "\u00a0", "x", "é", "9", "12345678901", "-", ",", "\n"]
    values = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 9))) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "v string").select(
        "v", text.drop_first_word("v", "county").alias("word"), text.drop_first("v", r"\(.*\)").alias("brackets"),
        text.trim_all("v").alias("trimmed"), text.squeeze_spaces("v").alias("squeezed"),
        text.pad_left("v", 8).alias("padded"), text.geoid_prefix("v").alias("prefix"))
    for r in df.collect():
        v = r["v"]
        assert r["word"] == re.sub(r"\bcounty\b", "", v, count=1)
        assert r["brackets"] == re.sub(r"\(.*\)", "", v, count=1)
        assert r["trimmed"] == re.sub(r"^\s+|\s+$", "", v)
        assert r["squeezed"] == re.sub(r"\s{2,}", " ", v)
        assert r["padded"] == v.rjust(8, "0")
        assert r["prefix"] == (re.match(r"[0-9]{9}", v) or [None])[0]


def test_missing_condition_falls_through(one):
    unknown = F.lit(None).cast("boolean")
    assert one(text.first_match([(unknown, "a"), (F.lit(True), "b")], "c")) == "b"
    assert one(text.first_match([(unknown, "a"), (F.lit(False), "b")], "c")) == "c"


def test_rate_message(one):
    assert one(text.rate_message(F.lit(1234).cast("long"), F.lit(2000).cast("long"), "keys match")) == (
        "1,234 of 2,000 keys match: 62%")


def test_county_names_are_cleaned(one):
    cases = {
        "Foo County (part)": "foo", "county county x": "county x", "A  B Census Area": "a b",
        "Acadia Parish": "acadia", "Parish of X": "parish of x", "\tBar ": "bar", None: None,
    }
    assert one(*[clean_county_name(lit(v)) for v in cases]) == tuple(cases.values())


def test_rules_by_list_and_by_table_agree(spark, rows):
    data = [("15", "kaua‘i"), ("35", "of dona ana"), ("06", "los angeles metropolitan"), ("07", "los angeles"),
            (None, "dayton"), ("39", "dayton"), ("39", "butler dayton"), ("01", None)]
    df = spark.createDataFrame(data, "state string, name string")
    rules = spark.createDataFrame(
        [(*r, i) for i, r in enumerate(COUNTY_RULES)], "scope string, kind string, text string, good string, priority int")
    listed = df.withColumn("good", recode_by_rules(F.col("state"), F.col("name"), COUNTY_RULES))
    tabled = recode_by_table(df.withColumn("good", F.col("name")), "state", "good", rules)
    assert rows(listed) == rows(tabled.select(*listed.columns))
    good = {(r["state"], r["name"]): r["good"] for r in listed.collect()}
    assert good[("15", "kaua‘i")] == "kauai" and good[("35", "of dona ana")] == "doña ana"
    assert good[("06", "los angeles metropolitan")] == "los angeles" and good[("07", "los angeles")] == "los angeles"
    assert good[("39", "dayton")] == "montgomery" and good[(None, "dayton")] == "dayton"


def test_the_first_rule_wins(spark):
    rules = [("a", "has", "x", "one"), ("a", "is", "xy", "two"), ("b", "is", "xy", "three"), ("b", "has", "x", "four")]
    df = spark.createDataFrame([("a", "xy"), ("b", "xy"), ("b", "xz")], "s string, v string")
    table = spark.createDataFrame([(*r, i) for i, r in enumerate(rules)], "scope string, kind string, text string, good string, priority int")
    listed = df.select("s", "v", recode_by_rules(F.col("s"), F.col("v"), rules).alias("good")).collect()
    tabled = recode_by_table(df.withColumn("good", F.col("v")), "s", "good", table).collect()
    assert sorted(r["good"] for r in listed) == ["four", "one", "three"]
    assert sorted(r["good"] for r in tabled) == ["four", "one", "three"]


def test_many_rules_by_index_equal_the_array(spark):
    """Rules of every length, the empty one too, against the row-wise search."""
    rng = random.Random(3)
    syllables = ["ka", "lo", "mi", "ren", "st", "u", "ñ", " "]
    texts = {"".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(300)}
    rules = [(scope, rng.choice(["has", "is"]), text, f"{scope}-{text}") for text in sorted(texts) for scope in "ab" if rng.random() < 0.6]
    rng.shuffle(rules)
    rules = [r for r in rules if len(r[2]) > 1] + [r for r in rules if len(r[2]) == 1] + [("a", "has", "", "any")]
    names = [(rng.choice("abc"), "".join(rng.choice(syllables) for _ in range(rng.randint(0, 7)))) for _ in range(3000)] + [(None, "kalo"), ("a", None), ("b", "")]
    df = spark.createDataFrame(names, "s string, v string")
    table = spark.createDataFrame([(*r, i) for i, r in enumerate(rules)], "scope string, kind string, text string, good string, priority int")
    listed = df.select("s", "v", recode_by_rules(F.col("s"), F.col("v"), rules).alias("good"))
    tabled = recode_by_table(df.withColumn("good", F.col("v")), "s", "good", table).select("s", "v", "good")
    assert listed.exceptAll(tabled).isEmpty() and tabled.exceptAll(listed).isEmpty()
    assert listed.filter("v = good").count() < 2500
    none = recode_by_table(df, "s", "v", table.limit(0))
    assert none.exceptAll(df).isEmpty() and none.count() == df.count()
