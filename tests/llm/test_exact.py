from collections import defaultdict

from pyspark.sql import functions as F

from placeweave.llm.exact import exact_groups, fold_into_state

from .conftest import AWKWARD


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in (text or ""))


def expected(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[lower(text)].append(doc_id)
    return sorted((str(i), str(max((x for x in g if x is not None), default=None)), len(g)) for g in groups.values() for i in g)


def found(df):
    return sorted((str(r.doc_id), str(r.keep_id), r.group_size) for r in df.collect())


def test_awkward_rows_and_clashing_columns(spark, awkward, on_disk):
    got = exact_groups(spark, on_disk(awkward))
    assert found(got) == expected(AWKWARD)
    assert got.where("kept").count() == len({lower(r[1]) for r in AWKWARD})  # one row a group, repeated rows included


def test_empty_table(spark, nothing, on_disk):
    assert exact_groups(spark, on_disk(nothing)).count() == 0


def test_colliding_digests_are_told_apart_by_bytes(spark, docs_of, on_disk):
    rows = [(i, f"text {i % 23}") for i in range(200)]
    weak = exact_groups(spark, on_disk(docs_of(rows)), digest=lambda normal: F.unhex(F.substring(F.sha2(normal, 256), 1, 1)))
    assert found(weak) == expected(rows)
    assert weak.where("kept").count() == 23


def test_state_lives_on_and_takes_up_new_files_only(spark, docs_of, on_disk, tmp_path):
    state = f"{tmp_path}/state"
    path = on_disk(docs_of([(1, "a"), (2, "b")]))
    fold_into_state(spark, path, state)
    docs_of([(3, "A"), (4, "c")]).write.mode("append").parquet(path)
    got = exact_groups(spark, path, state=state, batch_bytes=1)
    assert found(got) == expected([(1, "a"), (2, "b"), (3, "A"), (4, "c")])


def test_plan_has_no_python(spark, docs_of, on_disk):
    plan = exact_groups(spark, on_disk(docs_of([(1, "a"), (2, "A")])))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
