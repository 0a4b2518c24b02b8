"""Words are told apart by their bytes: long words with a structure that defeats polynomial hashes, and hashes that all collide."""

import re

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("corpus_pipeline")

from pavestone.llm import decontaminate, jaccard, packing, quality, substrings, textkit  # noqa: E402


def thue_morse(n, swap=False):
    return "".join("ab"[(i.bit_count() + swap) % 2] for i in range(n))


PAIR = [thue_morse(2048), thue_morse(2048, True)]


@pytest.fixture(params=["real", "all equal", "by length"])
def hashed(request, monkeypatch):
    if request.param == "all equal":
        monkeypatch.setattr(textkit.Words, "hashes", lambda self: np.zeros(len(self.start), np.uint64))
    elif request.param == "by length":
        monkeypatch.setattr(textkit.Words, "hashes", lambda self: (self.end - self.start).astype(np.uint64) % 2)
    return request.param


def test_long_words_have_hashes_of_their_own():
    for n in (64, 128, 512, 1024, 2048):
        w = textkit.Words(pa.array([thue_morse(n) + " " + thue_morse(n, True)]))
        assert len(set(w.hashes().tolist())) == 2


def test_kinds(hashed):
    texts = ["b a ab a ba", None, "", " ".join(PAIR) + " a", "ab é " + PAIR[0]]
    w = textkit.Words(pa.array(texts))
    words = [x for t in texts for x in (t or "").split()]
    first, kind = w.distinct()
    assert len(first) == len(set(words))
    for i in range(len(words)):
        for j in range(len(words)):
            assert (kind[i] == kind[j]) == (words[i] == words[j])
        assert words[first[kind[i]]] == words[i]


def test_quality_rules_on_colliding_words(hashed):
    # the pair in turn: no 8-gram occurs twice
    text = " ".join([f"w{i} {PAIR[i.bit_count() % 2]}" for i in range(40)])
    got = quality._measure(pa.array([1]), pa.array([text])).to_pylist()[0]
    assert got["n_repeat_words"] == 0 and got["n_words"] == 80


def test_benchmark_words_on_colliding_hashes(hashed):
    item = " ".join(["one two three", PAIR[0], "four five six seven eight nine"])
    phrases = decontaminate.Phrases([7], [item])
    texts = ["x " + item + " y", "x " + item.replace(PAIR[0], PAIR[1]) + " y", None]
    found = decontaminate.Found(pa.array(texts))
    found.search(phrases)
    rows = found.rows(pa.array([1, 2, 3]), pa.array(texts)).to_pylist()
    assert [r["n_hit"] for r in rows] == [10, 0, 0] and rows[0]["items"] == ["7"]


def test_token_ids_on_colliding_hashes(hashed):
    texts = [" ".join(PAIR), "the a an the", PAIR[1] + " of", "An a OF, of."]
    own = packing.WordIds(packing.vocabulary_path())
    for _ in range(2):  # the second time from what is kept
        for t in texts:
            w = textkit.Words(pa.array([t]))
            assert own.of(w)[0].tolist() == own.tokenizer.encode(t, add_special_tokens=False).ids


def test_shingles_and_windows_of_the_pair(spark):
    pad = " ".join(f"w{i}" for i in range(30))
    rows = [(1, f"{pad} {PAIR[0]} z"), (2, f"{pad} {PAIR[1]} z"), (3, " ".join([PAIR[0]] * 4)), (4, " ".join([PAIR[1]] * 4))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets = {r.doc_id: r.component_id for r in jaccard.similar_documents(docs).collect()}
    assert sets[3] == 3 and sets[4] == 4
    kept = {r.doc_id: r.text for r in substrings.remove_repeats(docs).collect()}
    assert PAIR[0] in kept[1] and PAIR[1] in kept[2] and kept[3] == rows[2][1] and kept[4] == rows[3][1]


def test_ids_of_words_are_those_of_the_tokenizer():
    """Letters and signs are encoded apart, each once; signs after letters, apostrophes, digits, capitals that become two letters, and words seen before."""
    import pyarrow as pa

    from pavestone.llm.packing import WordIds, vocabulary_path
    from pavestone.llm.textkit import Words

    texts = ["Word word. WORD### word,&&& it's don't 'tis x1 1234 ÀÉ#$ ſ İstanbul ΑΣ Σ%%% a_b a- `q` [x] {y} ~z~ été* <|endoftext|>", "word. new### Straße!? 中文. word '", "", None]
    ids = WordIds(vocabulary_path())
    for _ in range(2):
        w = Words(pa.array(texts))
        got, count = ids.of(w)
        want = [ids.tokenizer.encode(t, add_special_tokens=False).ids for t in " ".join(x for x in texts if x).split()]
        assert count.tolist() == [len(x) for x in want] and got.tolist() == [i for x in want for i in x]
    assert "word" in ids.pieces and "###" in ids.pieces and len([k for k in ids.pieces if k.startswith("word")]) == 1
