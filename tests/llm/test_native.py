import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.llm import mixing, pii, rules, sharding

WORD = re.compile("[^\x20\x09-\x0d]+")


def no_python(df):
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().toString())


def best_capacity(sizes, shards):
    """The smallest capacity of contiguous shards over ordered sizes."""
    low, high = max(sizes), sum(sizes)
    while low < high:
        middle, used, room = (low + high) // 2, 1, 0
        room = middle
        for s in sizes:
            if s > room:
                used, room = used + 1, middle
            room -= s
        low, high = (low, middle) if used <= shards else (middle + 1, high)
    return low


@pytest.mark.parametrize("hot", [0, 200])
def test_shards(docs_of, monkeypatch, hot):
    monkeypatch.setattr(sharding, "FIRST_CELLS", 4)
    monkeypatch.setattr(sharding, "FINER_CELLS", 4)
    monkeypatch.setattr(sharding, "SUBCELL_ROWS", 10)
    random = np.random.default_rng(2)
    rows = [(i, "z" * int(random.integers(0, 60)) + str(i % 300)) for i in range(500)] + [(1000 + i, "hot " * 20) for i in range(hot)]
    found = sharding.shards_by_bytes(docs_of(*rows), 6)
    no_python(found)
    by, slots, groups = Counter(), defaultdict(list), {}
    texts = dict(rows)
    for r in found.collect():
        assert r.size == len(texts[r.id]) + 8 and r.text_crc32 == zlib.crc32(texts[r.id].encode())
        assert groups.setdefault(texts[r.id], r.shard) == r.shard
        by[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(by) <= set(range(6))
    sizes = defaultdict(int)
    place = {r.id: r.place for r in found.collect()}
    for i, t in rows:
        sizes[place[i]] += len(t) + 8
    own = [sizes[p] for p in sorted(sizes) if not (hot and p == place[1000])]
    assert max(n for s, n in by.items() if not (hot and s == groups["hot " * 20])) == best_capacity(own, 5 if hot else 6)


def test_shards_of_awkward_rows(awkward, clashing, empty):
    for docs in (awkward, clashing):
        rows = sharding.shards_by_bytes(docs, 4).collect()
        assert len(rows) == docs.count()
        nulls = [r for r in rows if r.id == 3]
        assert nulls[0].size == 8 and nulls[0].text_crc32 == 0
    assert sharding.shards_by_bytes(empty, 4).count() == 0


def plain_targets(sizes, weights, share):
    """Targets by raising one level over all sources until the capped shares add up."""
    budget, capped = share * sum(sizes.values()), {}
    while True:
        free = [s for s in sizes if s not in capped]
        level = (budget - sum(capped.values())) / sum(weights[s] for s in free) if free else 0
        over = [s for s in free if level * weights[s] > 2 * sizes[s]]
        if not over:
            return {s: capped.get(s, level * weights[s]) for s in sizes}
        capped |= {s: 2.0 * sizes[s] for s in over}


def test_mix(docs_of, monkeypatch):
    monkeypatch.setattr(mixing, "CELL_ROWS", 20)
    random = np.random.default_rng(3)
    names = ["a", "b", "Z", "é", None]
    rows = [(i, "w " * int(random.integers(0, 30)), names[min(4, i % 11)]) for i in range(600)]
    docs = docs_of(*rows)
    found = mixing.mix(docs)
    no_python(found)
    got = found.collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.mix(docs.repartition(7)).collect()))
    source = {i: s for i, _, s in rows}
    total, taken, largest = Counter(), Counter(), Counter()
    for r in got:
        assert r.size == len(WORD.findall(rows[r.id][1])) and r.taken in (0, r.size, 2 * r.size)
        total[source[r.id]] += r.size
        taken[source[r.id]] += r.taken
        largest[source[r.id]] = max(largest[source[r.id]], r.size)
    order = sorted((n for n in names if n is not None), key=lambda n: n.encode()) + [None]
    want = plain_targets(total, {n: (3, 1, 2)[k % 3] for k, n in enumerate(order)}, 1.5)
    for r in got:
        assert abs(r.target - want[source[r.id]]) < 1e-6 and r.source_size == total[source[r.id]]
    assert all(abs(taken[s] - want[s]) <= largest[s] for s in names)
    again = Counter(r.doc_id for r in mixing.mixed_rows(docs).collect())
    assert again == Counter({r.id: r.taken // r.size for r in got if r.taken})


def test_mix_of_awkward_rows(awkward, clashing, empty):
    for docs in (awkward, clashing):
        assert mixing.mix(docs).count() == docs.count()
        kept = mixing.mixed_rows(docs)
        assert kept.columns == docs.columns
        words = kept.filter("text IS NOT NULL").count()
        assert words == kept.count() > 0
    assert mixing.mix(empty).count() == 0 and mixing.mixed_rows(empty).count() == 0


def plain_counts(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = Counter(windows)
    covered = {j for i, w in enumerate(windows) if times[w] > 1 for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    symbols = len(re.findall("[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_measures(awkward, clashing, empty, docs_of):
    more = docs_of((1, "a b c d e a b c d e f\n\nq\nq\n #%\n#%"), (2, "a " * 9), (3, "a b c d e f a b c d e"), (4, "x y z w v " * 3))
    for docs in (awkward, clashing, more):
        found = rules.judged(docs)
        no_python(found)
        rows = found.collect()
        assert len(rows) == docs.count()
        got = sorted((str(r.id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows)
        assert got == sorted((str(r.doc_id), *plain_counts(r.text)) for r in docs.collect())
        for r in rows:
            assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
            assert not (r.base_failed and r.kept)
    assert rules.judged(empty).count() == 0


def test_votes_tell_good_from_bad():
    random = np.random.default_rng(5)
    names, counts, good_of = [f"r{i}" for i in range(6)], Counter(), Counter()
    for _ in range(20_000):
        good = random.random() < 0.85
        votes = tuple(int(v) for v in np.where(random.random(6) < 0.2, 0, np.where(random.random(6) < (0.97 if good else 0.5), 1, -1) if good else np.where(random.random(6) < 0.6, -1, 1)))
        counts[votes] += 1
        good_of[votes] += good
    found = rules.estimate(list(counts.items()), names)
    assert abs(found.share - 0.85) < 0.05
    right = sum(good_of[v] if found.odds(dict(zip(names, v, strict=True))) >= 0 else n - good_of[v] for v, n in counts.items())
    assert right / 20_000 > 0.95


CASES = [
    ("a.b+C9@mail3.example.com x", ["email"]), ("call +1 (017) 555-7713 or 212-555-0199.", ["phone", "phone"]),
    ("card 4111 1111 1111 1111 and 4111-1111-1111-1112", ["card"]), ("ip 192.168.1.1, 999.1.1.1, 1.2.3.4.5", ["ip"]),
    ("ssn 123-45-6789 and 000-12-3456", ["ssn"]), ("1984-02-29, 1983-02-29, 02/28/1999 31.12.2001 1699-01-01", ["date"] * 3),
    ("GB82 WEST 1234 5698 7654 32, GB83WEST12345698765432", ["iban"]), ("x" * 70_000 + " 1", []), ("no numbers", []), ("", []), (None, []),
    ('token = "b44e15e09fd311c3cf3163b66d5a9875b883d8ce"', ["secret"]), ("$1 \\1 123-45-6789", ["ssn"]),
    # A short token beside a value, values beside each other, and values inside a longer candidate that fails.
    ("card 4111111111111111 12/27", ["card"]), ("4111 1111 1111 1111 123", ["card"]), ("paid 4111111111111111 5 times", ["card"]),
    ("id 7 4111111111111111", ["card"]), ("7 3782 822463 10005 99", ["card"]), ("200 123 4111 1111 1111 1111", ["card"]),
    ("BE68539007547034 AND", ["iban"]), ("AT611904300234573201 OK", ["iban"]), ("ES9121000418450200051332 IS", ["iban"]),
    ("BE68 5390 0754 7034 4111 1111 1111 1111 1999-12-31", ["iban", "card", "date"]), ("DE12 4111 1111 1111 1111 00", ["card"]),
    ("BE68539007547034 A@B.COM 12 345@x.com", ["iban", "email", "email"]), ("4111-1111 1111-1111, 3056 930902 5904", ["card", "card"]),
    ("31/12/1999, 29/02/1900, 13/13/1999 05/06/2001", ["date", "date"]), ("+44 20 7946 0958, +33 1 42 68 53 00", ["phone", "phone"]),
    ("+49 (0)30 901820 4111 1111 1111 1111", ["phone", "card"]), ("+442079460958 or +39 06 6982 1999-12-31, +12 34", ["phone", "phone", "date"]),
]


def test_pseudonyms(spark):
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "doc_id long, text string")
    hidden = pii.pseudonymised(docs, "key", found_col="found")
    no_python(hidden)
    rows = {r.doc_id: r for r in hidden.collect()}
    for i, (text, kinds) in enumerate(CASES):
        assert [x.kind for x in rows[i].found] == kinds
        assert (rows[i].text == text) == (not kinds)
        assert all(x["value"] not in rows[i].text and x.pseudonym in rows[i].text for x in rows[i].found)
    # Pseudonyms are valid values of the same kind, and the key undoes them.
    again = {r.doc_id: r for r in pii.pseudonymised(hidden.drop("found"), "key", back=True, found_col="found").collect()}
    assert [again[i].text for i in range(len(CASES))] == [t for t, _ in CASES]
    other = {r.doc_id: r.text for r in pii.pseudonymised(docs, "another").collect()}
    assert other[0] != rows[0].text


def test_pseudonyms_among_other_numbers_can_be_undone(spark):
    # One in ten of the stretches of four groups is valid by chance, in the text or among the pseudonyms.
    docs = spark.range(400).selectExpr("id AS doc_id", "concat(lpad(id * 7919 % 10000, 4, '0'), ' 4111 1111 1111 1111 ', lpad(id, 4, '0')) AS text")
    hidden = pii.pseudonymised(docs, "key")
    assert hidden.filter("text LIKE '%4111 1111 1111 1111%'").count() == 0
    assert sorted(pii.pseudonymised(hidden, "key", back=True).collect()) == sorted(docs.collect())


def test_dates_keep_their_reading(spark):
    docs = spark.range(600).selectExpr("id AS doc_id", "date_format(date_add(DATE'1990-01-01', CAST(id AS INT)), 'dd/MM/yyyy') AS text")
    hidden = pii.pseudonymised(docs, "key").cache()
    late = hidden.join(docs.filter("substr(text, 1, 2) > '12'").select("doc_id"), "doc_id")
    assert late.filter("substr(text, 1, 2) > '12'").select("text").distinct().count() == late.count() > 300
    assert hidden.join(docs, ["doc_id", "text"]).count() < 3
    assert sorted(pii.pseudonymised(hidden, "key", back=True).collect()) == sorted(docs.collect())


def test_pseudonyms_are_a_permutation(spark):
    numbers = spark.range(189 * 773).select(F.expr(pii.feistel("id", "189L", "773L", "key", "date")).alias("x"))
    assert numbers.distinct().count() == 189 * 773
    assert numbers.agg(F.min("x"), F.max("x")).first() == (0, 189 * 773 - 1)


def test_pseudonyms_of_awkward_rows(awkward, clashing, empty):
    for docs in (awkward, clashing):
        out = pii.pseudonymised(docs, "key")
        assert out.columns == docs.columns and out.count() == docs.count()
    assert pii.pseudonymised(empty, "key").count() == 0


def test_variety_does_not_depend_on_length(docs_of):
    """The same junk of few distinct words is voted bad at any length, and a varied text good."""
    junk = [(n, " ".join(f"junk{k % 30}" for k in range(n))) for n in (499, 1999, 2000, 2001, 9000)]
    varied = [(100_000 + n, " ".join(f"word{k}" for k in range(n))) for n in (600, 5000)]
    found = {r.id: r.variety for r in rules.judged(docs_of(*junk, *varied)).collect()}
    assert {found[i] for i, _ in junk} == {-1} and {found[i] for i, _ in varied} == {1}


def _table_of_numbers(seed: int, many: int, least: int, most: int) -> str:
    draw = random.Random(seed)
    return " ".join(str(draw.randrange(10 ** draw.randint(least, most))) for _ in range(many))


def test_equal_values_have_one_pseudonym_among_any_numbers(spark):
    """Neighbours, separators and places of a card don't matter, and the way back is exact."""
    rows = []
    for i in range(120):
        least, most = [(1, 6), (4, 4), (3, 4), (6, 6)][i % 4]
        before, after = _table_of_numbers(i, 30, least, most), _table_of_numbers(1000 + i, 30, least, most)
        value = ["4111 1111 1111 1111", "4111111111111111", "4111-1111-1111-1111"][i % 3]
        rows.append((i, f"{before} x {value} y {after} 212-555-0199 {before} +44 20 7946 0958 1234 5678"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    hidden = pii.pseudonymised(docs, "key", found_col="found").cache()
    assert sorted(pii.pseudonymised(hidden.drop("found"), "key", back=True).collect()) == rows
    cards = hidden.select(F.explode("found").alias("x")).filter("x.kind = 'card' AND regexp_replace(x.value, '[^0-9]', '') = '4111111111111111'")
    assert cards.count() >= 120
    assert cards.select(F.regexp_replace("x.pseudonym", "[^0-9]", "")).distinct().count() == 1


def test_runs_of_groups_keep_their_values(spark):
    """Each value in rows of groups of four and six digits has one pseudonym, wherever the rows begin."""
    draw = random.Random(5)
    rows = [(i, " ".join(str(draw.randrange(10**9)).zfill(9)[:n] for n in draw.choices([4, 4, 4, 4, 6, 5, 3], k=40))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    hidden = pii.pseudonymised(docs, "key", found_col="found").cache()
    assert sorted(pii.pseudonymised(hidden.drop("found"), "key", back=True).collect()) == rows
    pairs = hidden.select(F.explode("found").alias("x")).select("x.kind", "x.value", "x.pseudonym").distinct()
    assert pairs.count() > 100 and pairs.groupBy("kind", "value").count().filter("count > 1").count() == 0


def test_numbers_without_meaning_stay(spark):
    """Fewer than one in a thousand plain numbers is taken for a value, also in one very long table of them."""
    docs = spark.createDataFrame([(1, _table_of_numbers(7, 20_000, 1, 6))], "doc_id long, text string")
    hidden = pii.pseudonymised(docs, "key", found_col="found").cache()
    assert hidden.selectExpr("size(found) AS n").first().n < 20
    assert pii.pseudonymised(hidden.drop("found"), "key", back=True).collect() == docs.collect()
