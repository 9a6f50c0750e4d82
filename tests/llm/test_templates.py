from placeweave.llm.templates import CHARACTERS, WINDOW, Canonical, _gathered, best_alignment, decontaminated, leaks

from .conftest import words

ITEM = ("A train leaves Boston at 9 am and travels 120 miles to Albany at 40 mph. Later a second train leaves Boston at 11 am "
        "and travels the same way at 60 mph. When will it meet the first train?")
ASKED_ANEW = ("A train leaves Denver at 7 am and travels 300 miles to Laramie at 50 mph. Later a second train leaves Denver at 8 am "
              "and travels the same way at 75 mph. When will it meet the first train?")
MIXED_UP = ASKED_ANEW.replace("leaves Denver at 8 am", "leaves Chicago at 8 am")


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_copies_recased_copies_and_new_parameters_are_met(spark, docs_of):
    rows = [(1, f"{words(1, 60)} {ITEM} {words(2, 60)}"), (2, f"{words(3, 30)}. {ITEM.upper()}"), (3, f"{words(4, 9)}. {ASKED_ANEW} {words(5, 9)}"),
            (4, f"{words(4, 9)}. {MIXED_UP} {words(5, 9)}"), (5, words(9, 300)), (6, "A train leaves Boston at 9 am and travels 120 miles.")]
    got = {(r.doc_id, r.item_id, r.reparameterised) for r in leaks(docs_of(rows), items(spark, [(70, ITEM), (71, words(50, 40))])).collect()}
    assert got == {(1, 70, False), (2, 70, False), (3, 70, True)}


def test_an_inserted_word_shifts_but_does_not_hide(spark, docs_of):
    changed = ITEM.replace("travels the same", "then travels the very same")
    assert leaks(docs_of([(1, changed)]), items(spark, [(1, ITEM)])).count() == 1


def test_awkward_rows(spark, awkward):
    bench = items(spark, [(1, None), (None, ITEM), (2, ""), (3, "short"), (4, words(6, 120)), (4, words(6, 120))])
    got = sorted((str(r.doc_id), r.item_id) for r in leaks(awkward, bench).collect())
    assert got == sorted((i, 4) for i in ("6", "6", "7", "8", "None"))
    left = decontaminated(awkward, bench)
    assert left.columns == awkward.columns
    assert left.count() == awkward.count() - 5


def test_empty_tables(spark, nothing, docs_of):
    assert leaks(nothing, items(spark, [(1, ITEM)])).count() == 0
    assert leaks(docs_of([(1, ITEM)]), items(spark, [])).count() == 0
    assert decontaminated(docs_of([(1, ITEM)]), items(spark, [])).count() == 1


def test_windows_stand_at_their_tokens():
    hashes, pos, _ = Canonical().windows(words(1, 50))
    again, _, _ = Canonical().windows("noise before. " + words(1, 50))
    assert len(hashes) and set(hashes.tolist()) <= set(again.tolist()) and pos.max() <= 100 - WINDOW


def test_texts_cut_together_give_the_windows_of_each_alone():
    texts = [None, "", "a", "New York. Paris in May 12 km. X", ITEM, "\n. .", "12 34 55 kg 7 % 88 99 Boston", "km 5 km 6 km 7 km 8 km 9 km 10 km",
             ASKED_ANEW.upper(), "one two three four five six", words(1, 300), "5", "5 kg", "Boston leaves ß İ x²y"]
    for short in ((), (1,), (3, 5)):
        hashes, of, pos, slots = Canonical().windows_of(texts, short)
        together = sorted((int(k), int(h), int(p), slots(i)) for i, (k, h, p) in enumerate(zip(of, hashes, pos, strict=True)))
        alone = []
        for k, t in enumerate(texts):
            hashes, pos, slots = Canonical().windows(t, short)
            alone += [(k, int(h), int(p), slots(i)) for i, (h, p) in enumerate(zip(hashes, pos, strict=True))]
        assert together == sorted(alone) and len(alone) > 300
    assert [len(x) for x in Canonical().windows_of([])[:3]] == [0, 0, 0]


def test_texts_are_gathered_whole_and_in_order():
    texts = ["", "x" * (CHARACTERS + 1), "", *("y" * (CHARACTERS // 3) for _ in range(7)), "z"]
    runs = list(_gathered(texts))
    assert [t for _, run in runs for t in run] == texts and [low for low, _ in runs] == [sum(len(r) for _, r in runs[:i]) for i in range(len(runs))]
    assert all(len(run) == 1 or sum(map(len, run)) <= CHARACTERS for _, run in runs) and len(runs) == 5
    assert list(_gathered([])) == []


def test_alignment_needs_one_offset():
    spread = [(i * 100, i, [], []) for i in range(20)]
    assert best_alignment(spread, 25)[0] == WINDOW / 25
    assert best_alignment([(7, i, [], []) for i in range(20)], 25)[0] == 1.0


def test_number_lists_sums_and_short_items_are_met(spark, docs_of):
    numbers = " ".join(str(17 + 29 * i) for i in range(20))
    bench = [(1, "17 23 45 9 81 12 64 33"), (2, f"Sort these values now {numbers} from least to most"), (3, "What is 17 plus 25?"), (4, "12 + 30 = 42 and 7 + 9 = 16")]
    rows = [(i, f"{words(i, 30)}. {t} {words(10 + i, 30)}") for i, t in bench]
    rows += [(11, "17 23 45 9 82 12 64 33"), (12, "Sort these values now 1 2 3 4 5 6 7 8 from least to most"), (13, "What is 18 plus 25?"), (14, words(9, 200))]
    got = {(r.doc_id, r.item_id, r.reparameterised) for r in leaks(docs_of(rows), items(spark, bench)).collect()}
    assert got == {(i, i, False) for i, _ in bench}
