import hashlib
import random
from collections import Counter

import pytest

from placeweave.llm import alignment
from placeweave.llm.alignment import Aligner, alignments, byte_alphabet, read_vocabularies

from .conftest import AWKWARD, words

ODD = ["a  b", "a\n b c", "  lead", "trail  ", "tab\t x \ty", "<|endoftext|> x <s> </s> <unk>", "▁x", "a▁ b", " ", "\n", " \t ", "a\x00 b", "é́ ﬁ ½",
       "a　 b", "<0x41> '  s", "x \x1c y \x85 z", "don't  'll 've", "日本語 😀", "1234,567.89", "ÀÉ‍x"]


@pytest.fixture(scope="module")
def files():
    return read_vocabularies()


@pytest.fixture(scope="module")
def plain(files):
    """Tokens of a whole text by the two libraries, as (ids, byte strings) a side; None if they do not give the text back."""
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_str(files[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_proto=files[1])
    alphabet = byte_alphabet()

    def encode(text):
        whole = (" " + (text or "")).encode()
        ids = a.encode(" " + (text or ""), add_special_tokens=False).ids, b.encode(text or "")
        out = [bytes(alphabet[c] for c in a.id_to_token(i)) for i in ids[0]], [
            bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids[1]]
        return (ids, out) if text and all(b"".join(x) == whole for x in out) else None
    return encode


def brute(rows, plain):
    """doc_id -> all measures, by comparing every token of A with every one of B."""
    found, count = [], Counter()
    for i, text, *_ in rows:
        encoded = plain(text)
        if encoded is None:
            found.append((i, 0, 0, "", []))
            continue
        ends = [[sum(map(len, side[:n + 1])) for n in range(len(side))] for side in encoded[1]]
        links = [(x, y, e) for x, e in zip(encoded[0][0], ends[0]) for y, f in zip(encoded[0][1], ends[1]) if e == f]
        groups, start = [], 0
        for _, _, e in links:
            groups.append("|".join(",".join(str(x) for x, f in zip(ids, at) if start < f <= e) for ids, at in zip(encoded[0], ends)))
            start = e
        count.update((x, y) for x, y, _ in links)
        found.append((i, len(ends[0]), len(ends[1]), hashlib.sha256(";".join(groups).encode()).hexdigest(), [(x, y) for x, y, _ in links]))
    best = Counter()
    for (_, y), n in count.items():
        best[y] = max(best[y], n)
    return sorted(((i, a, b, len(links), len(links), sum(count[p] == best[p[1]] for p in links), sum(count[p] for p in links), sha)
                   for i, a, b, sha, links in found), key=str)


def measured(df):
    return sorted(((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect()), key=str)


def test_awkward_rows_equal_brute_force(awkward, plain):
    short = awkward.where("doc_id IS NULL OR doc_id NOT IN (9, 10, 11)")
    assert measured(alignments(short)) == brute([r for r in AWKWARD if r[0] not in (9, 10, 11)], plain)


@pytest.mark.parametrize("broadcast", [0, 1_000_000])
def test_copies_count_every_time(docs_of, plain, broadcast):
    draw = random.Random(2)
    some = ["the them", "Anonly the,", "there there\nThe 12", "x x x", *ODD]
    rows = [(i, draw.choice(some)) for i in range(120)] + [(500, None), (501, "")]
    assert measured(alignments(docs_of(rows), broadcast_pairs=broadcast)) == brute(rows, plain)


def test_very_long_texts(docs_of):
    rows = [(1, "x" * 120_000), (2, " " * 50_000), (3, words(1, 20_000)), (4, "\n" * 5000)]
    found = {r.doc_id: r for r in alignments(docs_of(rows)).collect()}
    assert all(0 < found[i].n_groups <= min(found[i].n_a, found[i].n_b) for i in (1, 2, 3, 4))


def test_empty_table(nothing):
    assert alignments(nothing).count() == 0


def test_whole_texts_encode_as_the_libraries_do(files, plain):
    aligner, draw = Aligner(*files), random.Random(3)
    assert aligner.engine is not None
    made = ["".join(draw.choice([" ", "  ", "a", "the", "\n", "\t", "'s", "é", " ", "\x1c", "1", "!", "ß", "\x85", "’"]) for _ in range(draw.randrange(1, 12)))
            for _ in range(2000)]
    for text in [*ODD, *made, *(words(i, 300, "Überan") for i in range(5))]:
        if plain(text):
            assert tuple(map(list, aligner.encode(text))) == tuple(map(list, plain(text)[0]))


def test_missing_vocabulary_is_named(docs_of):
    with pytest.raises(FileNotFoundError, match="no/such.json"):
        alignments(docs_of([(1, "a")]), byte_vocabulary="no/such.json")


def test_a_tie_is_best_for_both(docs_of):
    """Both pairs of a B id that occur equally often count as its best."""
    assert alignment.BROADCAST_PAIRS > 0
    found = {r.doc_id: (r.n_links, r.n_best) for r in alignments(docs_of([(1, "one two"), (2, "one two")])).collect()}
    assert found[1] == found[2] and found[1][0] == found[1][1]
