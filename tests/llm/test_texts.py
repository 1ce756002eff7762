import hashlib
import math

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash

from quern.llm import bpe, quality, recompress, simhash, toxicity
from quern.llm import subwords as subwords_module

RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
VOCABULARY = bpe.Vocabulary(RANKS)
PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def plain_fingerprint(text, words=3):
    own = bytes(text or "", "utf8").lower().split()
    if not own:
        return 0
    shingles = [b" ".join(own[i : i + words]) for i in range(max(1, len(own) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def test_fingerprints(awkward):
    for text in ("A b C d", "a", "", None, "x y", "Ä B c d e f g", "one two three four five six " * 50):
        assert simhash.fingerprint(text) == plain_fingerprint(text)


def plain_components(prints):
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in ids:
        for j in ids:
            if i < j and (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_near_duplicates(awkward, clashing, empty):
    for docs in (awkward, clashing):
        rows = simhash.near_duplicates(docs).collect()
        texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id is not None}
        want = plain_components({i: plain_fingerprint(t) for i, t in texts.items()})
        assert len(rows) == docs.count()
        assert {r.id: r.component for r in rows if r.id is not None} == want
    assert simhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("block", [4, 1024])
def test_links_of_dense_groups(spark, block):
    from quern.llm.shared import Stage, components

    random = np.random.default_rng(2)
    middle = int(random.integers(1 << 62))
    near = {middle ^ (1 << a) ^ (1 << b) ^ (1 << c) for a, b, c in random.integers(0, 63, (150, 3)).tolist()}
    prints = sorted(near | set(random.integers(1 << 62, size=300).tolist()))
    df = spark.createDataFrame([(p,) for p in prints], "fingerprint long")
    stage = Stage(spark)
    found = {r.node: r.root for r in components(simhash.links(df, stage, block=block), stage).collect()}
    assert {p: found.get(p, p) for p in prints} == plain_components({p: p for p in prints})


def plain_kept(rows, window):
    seen, out = {}, {}
    for i, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        words = bytes(text or "", "utf8").split()
        gone = set()
        for p in range(len(words) - window + 1):
            if seen.setdefault(tuple(words[p : p + window]), (i, p)) != (i, p):
                gone |= set(range(p, p + window))
        out[i] = (len(words), len(gone), hashlib.sha256(b" ".join(w for p, w in enumerate(words) if p not in gone)).hexdigest())
    return out


def test_repeated_windows(awkward, clashing, empty):
    for docs in (awkward, clashing):
        rows = recompress.digests(docs, 5).collect()
        assert len(rows) == docs.count()
        want = plain_kept([(r.doc_id, r.text) for r in docs.collect()], 5)
        assert {r.id: tuple(r)[1:] for r in rows if r.id is not None} == want
        assert all(r.n_removed == 0 for r in rows if r.id is None)
    assert recompress.digests(empty, 5).count() == 0


def test_different_texts_of_one_id(docs_of):
    """They are taken one after the other; what only follows from them together is no window."""
    random = np.random.default_rng(6)
    rows = [(int(i) % 9, " ".join(f"w{x}" for x in random.integers(0, 3, random.integers(0, 70)))) for i in range(45)]
    rows += [(3, None), (3, ""), (4, rows[4][1]), (20, " ".join(f"u{k}" for k in range(50))), (20, " ".join(f"u{k}" for k in range(12)))]
    docs = docs_of(*rows)
    hashes = {(r[0], r[1]): r[2] for r in docs.selectExpr("doc_id", "text", "xxhash64(text)").collect()}
    ordered = sorted(set(rows), key=lambda r: (r[0], hashes[r]))
    seen, want = {}, {}
    for place, (i, text) in enumerate(ordered):
        words, gone = (text or "").split(), set()
        for p in range(len(words) - 7):
            if seen.setdefault(tuple(words[p : p + 8]), (place, p)) != (place, p):
                gone |= set(range(p, p + 8))
        want[i, text] = (len(words), len(gone), " ".join(w for p, w in enumerate(words) if p not in gone))
    got = recompress.kept_words(docs, 8).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(i, *want[i, t]) for i, t in rows], key=str)


@pytest.mark.parametrize("strip", [40, 200_000])
def test_windows_of_few_words(docs_of, monkeypatch, strip):
    """Texts of two or three words: runs, periods and everything shared."""
    monkeypatch.setattr(recompress, "STRIP", strip)
    random = np.random.default_rng(4)
    rows = [(int(i), " ".join("abc"[x] for x in random.integers(0, 2 + i % 2, random.integers(0, 90)))) for i in range(60)]
    rows += [(100 + i, "a b " * i) for i in range(30)] + [(200 + i, "a " * i) for i in range(40)]
    found = {r.id: tuple(r)[1:] for r in recompress.digests(docs_of(*rows), 8).collect()}
    assert found == plain_kept(rows, 8)


def test_kept_text(docs_of):
    docs = docs_of((1, "a b c d e f"), (2, "x a b c d y"))
    assert {r.id: r.kept for r in recompress.kept_words(docs, 3).collect()} == {1: "a b c d e f", 2: "x y"}


def test_reach_decides_symbols():
    """The same words in other surroundings are filed under the same names."""
    random = np.random.default_rng(6)
    middle = random.integers(0, 1 << 60, 60).astype(np.uint64)
    names = []
    for _ in range(4):
        words = np.concatenate([random.integers(0, 1 << 60, 30).astype(np.uint64), middle, random.integers(0, 1 << 60, 30).astype(np.uint64)])
        name, _, start, count = recompress.filed(words, np.array([0, len(words)]), 20)
        own = {}
        for n, s, c in zip(name, start, count, strict=True):
            own.update({p - 30: n for p in range(s, s + c) if 30 <= p <= 70})
        names.append(own)
    assert len(names[0]) == 41 and all(n == names[0] for n in names)


def test_bpe_equals_the_library():
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
    own = bpe.Encoder(VOCABULARY, public_tokenizers.PATTERN)
    random = np.random.default_rng(8)
    texts = ["", "hello world", "x" * 3000, "\n" * 700, " " * 999 + "a", "<|endoftext|>", "日本語" * 99, "\U0001f600‍\U0001f469"]
    texts += ["".join(chr(c) for c in random.integers(32, 1500, 80)) for _ in range(300)]
    texts += ["".join(random.choice(list("abAB01 .\n"), 200)) for _ in range(200)]
    for text in texts:
        assert own.encode(text) == library.encode_ordinary(text)
        assert own.decode(own.encode(text)) == text.encode()


def test_appends_and_edits():
    random = np.random.default_rng(9)
    for _ in range(60):
        piece = bytes(random.choice(list(b"abcdeing"), random.integers(0, 300)).tolist())
        own = bpe.PrefixEncoding(VOCABULARY, piece[: len(piece) // 2])
        own.append(piece[len(piece) // 2 :])
        assert own.ids() == bpe.PrefixEncoding(VOCABULARY, piece).ids()
        start, stop = sorted(random.integers(0, len(piece) + 1, 2).tolist())
        more = bytes(random.choice(list(b"abing"), random.integers(0, 9)).tolist())
        own.edit(start, stop, more)
        assert own.piece == piece[:start] + more + piece[stop:]
        assert own.lengths == bpe.PrefixEncoding(VOCABULARY, own.piece).lengths


def test_bpe_of_documents(awkward, clashing, empty):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
    for docs in (awkward, clashing):
        rows = bpe.digests(docs, PATH, public_tokenizers.PATTERN).collect()
        want = []
        for r in docs.collect():
            ids = library.encode_ordinary(r.text or "")
            digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
            want.append((r.doc_id, len(ids), digest, hashlib.sha256((r.text or "").encode()).hexdigest()))
        assert sorted(map(str, map(tuple, rows))) == sorted(map(str, want))
    assert bpe.encoded(empty, PATH, public_tokenizers.PATTERN).count() == 0


def labelled(spark, docs_of, mark):
    random = np.random.default_rng(1)
    rows = [(i, " ".join(mark(i, w) for w in random.choice(["house", "tree", "river", "stone", "light"], 30))) for i in range(400)]
    labels = [(i, int(i % 4 != 0), int(i % 4 == 0)) for i in range(300)] + [(1, None, None), (999, 1, 0)]
    return docs_of(*rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_quality(spark, docs_of, awkward, clashing, empty):
    docs, labels = labelled(spark, docs_of, lambda i, w: w + "###" if i % 4 == 0 else w)
    model = quality.fit(docs, labels, "quality", "doc_id % 5 = 0")
    found = {r.id: r.score for r in quality.scores(docs, model).collect()}
    assert all((found[i] >= 0.5) == (i % 4 != 0) for i in range(400))
    assert quality.fit(docs, labels, "quality", "doc_id % 5 = 0").bias.tolist() == model.bias.tolist()
    for other in (awkward, clashing):
        scores = quality.scores(other, model).collect()
        assert len(scores) == other.count() and all(0 <= r.score <= 1 for r in scores)
    assert quality.scores(empty, model).count() == 0
    nothing = quality.fit(docs, labels.limit(0), "quality")
    assert all(math.isclose(r.score, 0.5) for r in quality.scores(empty.unionByName(docs.limit(2)), nothing).collect())


def test_scores_equal_a_plain_scorer(docs_of, awkward, monkeypatch):
    """Whole arrays of a stretch of texts give what the features of each text by itself give."""
    monkeypatch.setattr(quality, "AT_ONCE", 3_000)
    random = np.random.default_rng(8)
    model = quality.Model(random.normal(size=(quality.BUCKETS, quality.WIDTH)), random.normal(size=(2, quality.WIDTH)), np.array([0.1, 0.3]))
    texts = [r.text for r in awkward.collect()] + ["a a a b\x1cb", "ß" * 70 + " x", "日本 語 " * 9, "word " * 400, "\u2003x\u00a0y"]
    subwords, margins = subwords_module.Subwords(quality.BUCKETS), model.margins()
    rows = [(i, t) for i, t in enumerate(texts)]
    got = {r.id: r.score for r in quality.scores(docs_of(*rows), model).collect()}
    for i, text in rows:
        place, times = subwords.counts(text)
        mean = margins[place] @ times.astype(float) / times.sum(dtype=float) if len(place) else 0.0
        assert abs(got[i] - 1 / (1 + math.exp(-mean - model.offset()))) < 1e-12


def test_toxicity(spark, docs_of, awkward, clashing, empty):
    docs, labels = labelled(spark, docs_of, lambda i, w: "you idiot" if i % 4 == 0 and w == "tree" else w)
    names = ["insult_mind", "insult_worth", "toxic"]
    models = toxicity.fit(docs, labels, "toxic", "doc_id % 5 = 0")
    found = {r.id: r for r in toxicity.probabilities(docs, models, names).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all((found[i].toxic >= 0.5) == ("idiot" in texts[i]) for i in range(400))
    assert all((found[i].insult_mind >= 0.5) == ("idiot" in texts[i]) for i in range(400))
    for other in (awkward, clashing):
        assert toxicity.probabilities(other, models, names).count() == other.count()
    assert toxicity.probabilities(empty, models, names).count() == 0
    nothing = toxicity.fit(docs, labels.limit(0), "toxic")
    assert all(r.toxic < 0.5 for r in toxicity.probabilities(docs.limit(2), nothing, names).collect())
