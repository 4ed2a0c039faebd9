"""Encoding (7), leaks (8) and shared spans (9)."""

import itertools
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stemma.llm import containment as C
from stemma.llm import encoding as E
from stemma.llm import spans as S


@pytest.fixture(scope="module")
def transducer():
    return E.Transducer(E.vocabulary_path(), window=23, long=1)


@pytest.fixture(scope="module")
def reference():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    t.encode_special_tokens = True
    return t


@settings(max_examples=150, deadline=None)
@given(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from("ab  \n\t'stée日")), max_size=200))
def test_encoding_equals_the_library_and_comes_back(transducer, reference, text):
    ids = transducer.encode(text)
    assert ids == reference.encode(text, add_special_tokens=False).ids
    assert "".join(transducer.decode(ids)) == text


def test_one_long_pretoken_is_streamed(transducer):
    random.seed(1)
    for letters in ("a", "ab", "abcdefgh", "агд", "日本", "-=", "0123"):
        text = "".join(random.choice(letters) for _ in range(6000))
        assert transducer.encode(text) == transducer.encoding.encode_ordinary(text)


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from("ab'se ll  \n日-1é"), max_size=300), st.integers(1, 40))
def test_borders_within_runs_are_final(transducer, text, window):
    t = E.Transducer.__new__(E.Transducer)
    t.__dict__ = transducer.__dict__ | {"long": 8}
    windows = [text[i : i + window] for i in range(0, len(text), window)]
    assert list(t.stream(windows)) == transducer.encoding.encode_ordinary(text)


@pytest.mark.parametrize("letters,n", [("学习研究模型数据", 60_000), ("a", 60_000), ("xy,", 60_000), (" ", 20_000), ("\n ", 20_000), ("0", 20_000), ("=-'s", 60_000)])
def test_held_text_is_bounded(letters, n):
    t = E.Transducer(E.vocabulary_path())
    random.seed(2)
    text = "".join(random.choice(letters) for _ in range(n)) + "x"
    assert t.encode(text) == t.encoding.encode_ordinary(text)
    assert t.most_held <= t.window + t.long


def test_special_strings_are_text(transducer, reference):
    assert transducer.encode("<|endoftext|>") == reference.encode("<|endoftext|>", add_special_tokens=False).ids != [50256]


def test_documents(spark):
    rows = [(1, "Hello world", "x"), (2, "", "x"), (3, None, "x"), (1, "Hello world", "x"), (4, " \n", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = sorted((r.doc_id, list(r.ids)) for r in E.encoded(df).collect())
    assert got[0] == got[1] == (1, [15496, 995]) and got[2:4] == [(2, []), (3, [])]
    assert sorted(r.text for r in E.decoded(E.encoded(df)).collect()) == sorted(t or "" for _, t, _ in rows)
    assert E.encoded(df.limit(0)).count() == 0


ITEM = "Which log shows that a retired surveyor gave up on a painted buoy one dawn in April and rain gauge 7894 sang about the tide clock during vessel wakes, long before clerk 4733 overheard brass valve 4733 beyond pier 91?"
FILLER = "We study creep in rail ballast subject to brackish water and report many measurements from the observatory. " * 6


def _leaks(spark, texts, items=((1, ITEM),), block=C.BLOCK_ITEMS):
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return {(r.doc_id, r.item_id) for r in C.leaks(d, spark.createDataFrame(list(items), "item_id long, text string"), block).collect()}


def test_leaks(spark):
    w = ITEM.split()
    half = " ".join(w[:20])
    two = FILLER + " ".join(w[:11]) + ". " + FILLER + " ".join(w[-11:])
    changed = " ".join("other" if i % 5 == 2 else x for i, x in enumerate(w))
    random.seed(2)
    mixed = random.sample(w, len(w))
    wrapped = ITEM.replace("surveyor", "sur-\nveyor").upper().replace(" ", "\n", 9)
    texts = [FILLER + half + " " + FILLER, two, FILLER + changed, FILLER + wrapped, FILLER + " ".join(mixed), FILLER + " ".join(w[:9]) + FILLER, None, "", "   ", FILLER, "a retired surveyor"]
    assert _leaks(spark, texts) == {(0, 1), (1, 1), (2, 1), (3, 1)}
    assert _leaks(spark, texts, [(1, ITEM), (2, None), (3, ""), (4, "word")]) == {(0, 1), (1, 1), (2, 1), (3, 1)}
    assert _leaks(spark, texts, [(1, ITEM), (5, "Another item that is about nothing at all but long enough to count.")], block=1) == {(0, 1), (1, 1), (2, 1), (3, 1)}


def test_search_misses_nothing_that_brute_force_finds():
    random.seed(4)
    vocabulary = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(random.choices(vocabulary, k=random.randint(12, 60)))) for i in range(40)]
    texts = []
    for _ in range(150):
        body = random.choices(vocabulary, k=random.randint(0, 300))
        if random.random() < 0.6:
            piece = random.choice(items)[1].split()
            piece = piece[: max(8, int(len(piece) * random.uniform(0.4, 1)))]
            piece = [random.choice(vocabulary) if random.random() < 0.12 else x for x in piece]
            at = random.randint(0, len(body))
            body[at:at] = piece
        texts.append(" ".join(body))
    index = C.ItemIndex(tuple(items))
    got = {(d, n) for d, n, _ in C.search(index, texts)}
    want = {(d, n) for d, t in enumerate(texts) for n, (_, i) in enumerate(items) if C.held_words(C.words(i), C.words(t)) >= 0.5 * len(C.words(i))}
    assert len(want) > 40 and got <= want and len(got) >= 0.97 * len(want)


def _brute(texts, n):
    grams = {}
    for i, t in enumerate(texts):
        for p in range(len(t or "") - n + 1):
            grams.setdefault(t[p : p + n], set()).add(i)
    return {p for s in grams.values() for p in itertools.combinations(sorted(s), 2)}


@settings(max_examples=40, deadline=None)
@given(st.randoms(use_true_random=False), st.integers(20, 40))
def test_every_shared_span_shares_a_fingerprint(rnd, n):
    shared = "".join(rnd.choice("abé日😀") for _ in range(n))
    a = "".join(rnd.choice("ab") for _ in range(rnd.randint(0, 90))) + shared + "x"
    b = "y" + shared + "".join(rnd.choice("ab") for _ in range(rnd.randint(0, 90)))
    assert set(S.fingerprints(a, 20)) & set(S.fingerprints(b, 20))


def test_long_texts_are_cut_into_blocks_without_loss(monkeypatch):
    rng = np.random.default_rng(1)
    text = "".join(chr(97 + x) for x in rng.integers(0, 26, 5000))
    whole = S.fingerprints(text, 40)
    monkeypatch.setattr(S, "_BLOCK", 300)
    assert set(whole) <= set(S.fingerprints(text, 40))


def test_spans_against_brute_force(spark):
    random.seed(6)
    pieces = ["".join(random.choice("abcdé ") for _ in range(random.randint(30, 90))) for _ in range(14)]
    texts = ["".join(random.choices(pieces, k=random.randint(1, 5))) for _ in range(40)] + [None, "", "short", "z" * 400, "z" * 300, pieces[0] * 6]
    texts += texts[:4]
    d = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, span string")
    for batches, hot in ((1, 64), (4, 64), (1, 3), (3, 2)):
        classes, spans = S.shared_spans(d, 60, batches, hot)
        got = {(r.doc_id_a, r.doc_id_b) for r in S.sharing_pairs(classes, spans, 60).collect()}
        assert got == _brute(texts, 60)
        assert spans.where("rep is not null").isEmpty() == (hot == 64)
    extent = {r.doc_id: r for r in S.shared_extent(d, classes, spans).collect()}
    assert len(extent) == len(texts)
    for i, t in enumerate(texts):
        covered = set()
        for p in range(len(t or "") - 59):
            if any(t[p : p + 60] in (o or "") for j, o in enumerate(texts) if j != i):
                covered |= set(range(p, p + 60))
        assert extent[i].shared_chars == len(covered) and extent[i].n_chars == len(t or "")


def test_a_repeated_passage_is_found_where_it_goes_on():
    half, rest = "h" * 15 + "abcdefghijklmno", "pqrstuvwxyz" * 3
    a, b = half + "!" + half + rest, "?" + half + rest
    x, y = S.common_spans(S.code_points(a), S.code_points(b), 40)
    assert x == [(len(half) + 1, len(half + rest))] and y == [(1, len(half + rest))]


def test_spans_of_an_empty_table(spark):
    d = spark.createDataFrame([], "doc_id long, text string")
    classes, spans = S.shared_spans(d)
    assert S.sharing_pairs(classes, spans).count() == 0


def test_a_hot_passage_is_linked_to_its_representative_only(spark):
    random.seed(9)
    noise = lambda: "".join(random.choice("abcdefghij ") for _ in range(200))
    passage = "".join(random.choice("xyz ") for _ in range(90))
    d = spark.createDataFrame([(i, noise() + passage + noise()) for i in range(40)], "doc_id long, text string")
    classes, spans = S.shared_spans(d, 60, 2, 8)
    assert spans.count() < 3 * 40  # not 780
    assert S.sharing_pairs(classes, spans, 60).count() == 40 * 39 // 2
    assert {r.shared_chars for r in S.shared_extent(d, classes, spans).collect()} <= set(range(90, 105))


def test_an_index_is_opened_again(spark, tmp_path):
    a = "the quick brown fox jumps over the lazy dog and runs away into the woods"
    row = lambda i: spark.createDataFrame([(i, f"{i} unlike {i * i} " + a)], "doc_id long, text string")
    first = S.SpanIndex(spark, 30, folder=str(tmp_path / "index"))
    first.add(row(0))
    first.add(row(1))
    first.close()
    again = S.SpanIndex(spark, 30, folder=str(tmp_path / "index"))
    assert {(r.doc_id_a, r.doc_id_b) for r in again.add(row(2)).collect()} == {(0, 2), (1, 2)}
    again.close()
    with pytest.raises(ValueError):
        S.SpanIndex(spark, 40, folder=str(tmp_path / "index"))


def test_index_is_incremental_and_compacts(spark):
    a = "the quick brown fox jumps over the lazy dog and runs away into the woods"
    index = S.SpanIndex(spark, 30, fan_in=2)
    for i in range(5):
        found = index.add(spark.createDataFrame([(i, f"{i} unlike {i * i} " + a)], "doc_id long, text string"))
        assert {(r.doc_id_a, r.doc_id_b) for r in found.collect()} == {(j, i) for j in range(i)}
    assert sorted(r.level for r in index.runs) == [0, 2]
    index.close()
