"""Token files, Merkle manifests and importance resampling against brute force, on ordinary and on odd tables."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

pytest.importorskip("corpus_pipeline")

from pavestone.llm import merkle, resampling, token_files  # noqa: E402
from pavestone.llm.textkit import ALNUM, Words  # noqa: E402
from pavestone.storage import new_path  # noqa: E402

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
COLUMNS = "doc_id long, source string, lang string, n_chars long, text string, Text string, part long, file int, rank int, Doc_ID string, tree string"


def make_rows():
    r = random.Random(3)
    vocabulary = [f"Word{i}" for i in range(300)] + ["Éa", "ß", "naïve", "don't", "x" * 400, "A-B", "\t", "\n\n"]
    text = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    texts = [None, "", " \n", "one", "The the THE", text(30000), text(300)] + [text(r.randint(1, 90)) for _ in range(120)]
    rows = [(i * 7 - 20, r.choice(["web", None]), r.choice(["en", "en", "en", "de", None, ""]), r.choice([None, len(t or "")]), t) for i, t in enumerate(texts)]
    rows += [rows[6], rows[6], rows[1], (rows[6][0], "other", rows[6][2], 1, "same id"), (None, "web", "en", 3, "no id at all"), (None, None, None, None, None)]
    rows.append((10**15, "web", "fr", 1, "alone in its language"))
    return rows


ROWS = make_rows()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, "clash", 1, 2, 3, "d", "t") for r in ROWS], COLUMNS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.mark.parametrize(("bits", "block", "most"), [(token_files.BYTES, 1 << 15, 1 << 20), (token_files.BITS, 64, 500), (token_files.BYTES, 7, 1)])
def test_token_files(spark, docs, bits, block, most):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(token_files.vocabulary_path())
    want, flat = collections.defaultdict(list), []
    for i, _, _, _, text in sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 1]
        want[i].append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        flat.append((i, ids))
    path = new_path(spark, "test-token-files")
    token_files.write_token_files(docs, path, file_ids=most, bits=bits, block_ids=block)
    got = sorted(token_files.read_token_files(spark, path).collect(), key=lambda r: r.start)
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1].tolist()]
    assert [r.doc_id for r in got] == [i for i, _ in flat]
    have = collections.defaultdict(list)
    for r in got:
        have[r.doc_id].append((r.n_tokens, r.ids_crc32))
    assert {k: sorted(v) for k, v in have.items()} == {k: sorted(v) for k, v in want.items()}
    files = spark.read.parquet(path)
    assert all(r.n_ids <= most or r.n_docs == 1 for r in files.select("n_ids", "n_docs").collect())
    # a range of ids in the middle, over file and block borders
    total = got[-1].start + got[-1].n_tokens
    part = [r.id for r in token_files.read_ids(spark, path, total - 700, total - 3).orderBy("at").collect()]
    rest = []
    for r in got[::-1]:
        rest = next(ids for i, ids in flat if i == r.doc_id and (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) == (r.n_tokens, r.ids_crc32)) + rest
        if len(rest) >= 700:
            break
    assert part == rest[len(rest) - 700 : len(rest) - 3]


def test_token_file_reads_its_blocks_alone_and_rejects_damage(spark, none):
    ids = np.concatenate([np.arange(5000) * 37 % 65000, np.zeros(2000, int), [2**32 - 1, 0, 1]]).astype(np.uint32)
    for bits in (token_files.BITS, token_files.BYTES):
        content = token_files.encode_file(ids, np.array([5, 0]), np.array([False, True]), np.array([7000, 3]), bits, 512)
        f = token_files.TokenFile(content)
        assert (f.ids() == ids).all() and (f.ids(1000, 1030) == ids[1000:1030]).all() and len(f.ids(9, 9)) == 0
        asked, f.block = [], lambda k, own=f.block: asked.append(k) or own(k)
        f.ids(1030, 1600)
        assert asked == [2, 3]
        doc, null, n = f.documents()
        assert doc.tolist() == [5, 0] and null.tolist() == [False, True] and n.tolist() == [7000, 3]
        for bad in (content[:-1], b"", content[: len(content) // 2], content[:-70] + b"?" + content[-69:]):
            with pytest.raises(ValueError):
                token_files.TokenFile(bad)
    assert len(token_files.encode_file(np.zeros(1 << 16, np.uint32), np.zeros(1), np.zeros(1, bool), np.array([1 << 16]))) < 200
    path = new_path(spark, "test-no-files")
    token_files.write_token_files(none, path)
    assert token_files.read_token_files(spark, path).count() == 0


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, lower=False):
    i, source, lang, n, text = row
    if lower and text is not None:
        text = text.translate(LOWER)
    return digest("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in (i, source, lang, n, text)))


def brute_tree(nodes):
    """Its root and, per leaf, the siblings and the places of each level."""
    paths = [[] for _ in nodes]
    at = list(range(len(nodes)))
    while len(nodes) > 1:
        for leaf, k in enumerate(at):
            run = nodes[k // 8 * 8 : k // 8 * 8 + 8]
            paths[leaf].append((run[: k % 8], run[k % 8 + 1 :]))
        nodes = [digest("".join(nodes[k : k + 8])) for k in range(0, len(nodes), 8)]
        at = [k // 8 for k in at]
    return nodes[0], paths


def brute_manifest(rows):
    trees = collections.defaultdict(list)
    for r in rows:
        trees[r[2]].append(r)
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    low = []
    for lang in langs:
        trees[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        low.append(brute_tree([leaf_of(r) for r in trees[lang]]))
    root, above = brute_tree([x[0] for x in low]) if low else (None, [])
    out = []
    for lang, (sub, paths), over in zip(langs, low, above):
        for r, path in zip(trees[lang], paths):
            whole = path + over
            node = leaf_of(r, lower=r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0)
            for left, right in whole:
                node = digest("".join([*left, node, *right]))
            out.append((r[0], leaf_of(r), sub, root, digest("".join("".join(a + b) for a, b in whole)), node, node == root))
    return sorted(out, key=str)


@pytest.mark.parametrize("n", [0, 1, 2, 9, len(ROWS)])
def test_manifest(spark, docs, n):
    rows = ROWS[-n:] if n else []
    table = docs if n == len(ROWS) else spark.createDataFrame([(*r, "clash", 1, 2, 3, "d", "t") for r in rows], COLUMNS)
    got = sorted([tuple(r) for r in merkle.manifest(table).collect()], key=str)
    assert got == brute_manifest(rows)
    if n == len(ROWS):
        assert {r[-1] for r in got} == {True, False}


def test_only_requested_leaves_descend(spark):
    rows = [(i, "s", "en", 1, f"text {i}") for i in range(600)]
    table = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    ranked, _ = merkle.in_trees(merkle.leaves(table))
    dag = merkle.Dag(ranked.selectExpr("tree", "rank AS idx", "leaf AS digest", "n"))
    assert dag.height == 4
    starts = dag.roots.selectExpr("tree", "digest", "height", f"{merkle.EMPTY_PATH} AS path")
    few = ranked.where("rank IN (3, 4, 599)").selectExpr("tree", "rank", "leaf")
    got = merkle.proofs(few, dag, starts, every=False)
    root = dag.roots.first()["digest"]
    folded = got.select(merkle.folded(got["leaf"], got["path"]).alias("f"), "path").collect()
    assert len(folded) == 3 and all(r.f == root and len(r.path) == 4 for r in folded)
    # parents of requested leaves alone are found
    assert dag.descend(starts, few).count() == 2


def features(text):
    w = WORD.findall((text or "").translate(LOWER))
    return [" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)], len(w)


def brute_weights(rows, target, percent=5):
    buckets = lambda gs: collections.Counter(zlib.crc32(g.encode()) % 10000 for g in gs)
    own = [features(r[4]) for r in rows]
    s, t = buckets(g for gs, _ in own for g in gs), buckets(g for x in target for g in features(x)[0])
    many, most = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (many + 10000) / ((s[b] + 1) * (most + 10000)))) for b in range(10000)]
    out = []
    for r, (gs, n) in zip(rows, own):
        weight = sum(gain[zlib.crc32(g.encode()) % 10000] for g in gs)
        h = int(hashlib.sha256(f"42:{'' if r[0] is None else r[0]}".encode()).hexdigest()[:8], 16)
        out.append((r[0], len(gs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n >= 20))
    able = sorted((x for x in out if x[4]), key=lambda x: (-x[3], x[0] is None, x[0] or 0))
    ranks = collections.defaultdict(list)
    for k, x in enumerate(able[: len(able) * percent // 100]):
        ranks[x[:4]].append(k + 1)
    return sorted(((*x[:4], ranks[x[:4]].pop(0) if x[4] and ranks.get(x[:4]) else None) for x in out), key=str)


@pytest.mark.parametrize("percent", [5, 40, 100])
def test_resampling(spark, docs, percent):
    target = [None, "", "word1 word2 word3 word4", "the the", "naïve word5 " * 30]
    bench = spark.createDataFrame(list(enumerate(target)), "item_id long, text string")
    got = sorted([tuple(r) for r in resampling.resampled(docs, bench, percent).collect()], key=str)
    assert got == brute_weights(ROWS, target, percent)


def test_resampling_of_empty_tables(spark, docs, none):
    assert resampling.resampled(none, none).count() == 0
    got = sorted([tuple(r) for r in resampling.resampled(docs, none).collect()], key=str)
    assert got == brute_weights(ROWS, [])


def test_xxhash64_of_spans():
    import xxhash

    data = np.random.default_rng(1).integers(0, 256, 5000, dtype=np.uint8)
    length = np.array([*range(300), 3, 3, 4000])
    start = np.arange(len(length)) * 3
    got = resampling.xxh64(resampling.lanes_of(data), data, start, length)
    assert got.tolist() == [xxhash.xxh64_intdigest(data[a : a + n].tobytes()) for a, n in zip(start, length)]


@pytest.mark.parametrize("batch", [1 << 17, 5])
@pytest.mark.parametrize("hashed", [resampling.xxh64, lambda lanes, data, start, length: np.full(len(start), 2**64 - 1, np.uint64), lambda lanes, data, start, length: length.astype(np.uint64) % 3])
def test_table_tells_equal_hashes_apart(monkeypatch, batch, hashed):
    import pyarrow as pa

    monkeypatch.setattr(resampling, "BATCH_WORDS", batch)
    texts = ["a b a b a b c", None, "", "b a. A-b c", "longer words than eight bytes longerwords than eight byteS longer words", "ab abc abcd abcde"]
    have, per_text = collections.Counter(), collections.Counter()
    for data, start, length, doc in resampling.spans_of(Words(pa.array(texts), ALNUM, lower=True)):
        t = resampling.Interned(data, start, length, 97, hashed)
        raw = data.tobytes()
        names = [raw[a : a + n] for a, n in zip(start, length)]
        counts = collections.Counter(names)
        assert len(t.used) == len(counts) and len(set(t.slot.tolist())) == len(counts)
        for g, s in zip(names, t.slot):
            assert t.count[s] == counts[g] and t.bucket[s] == zlib.crc32(g) % 97
        have.update(x.decode() for x in names)
        per_text.update(doc.tolist())
    want = [features(x)[0] for x in texts]
    assert have == collections.Counter(g for gs in want for g in gs)
    assert per_text == collections.Counter({i: len(gs) for i, gs in enumerate(want) if gs})
