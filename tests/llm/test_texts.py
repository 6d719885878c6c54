import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimsight.llm import jaccard, langid, lines, mixing, rules


def near(a, b, edits):
    if abs(len(a) - len(b)) > edits:
        return False
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1] <= edits


def test_line_dedup_equals_brute_force(odd_docs, no_docs, monkeypatch):
    monkeypatch.setattr(lines, "HOT_PAIRS", 2)
    docs = list({(r.doc_id, r.text) for r in odd_docs.collect()})
    places = sorted(
        (-1 if d is None else d, p, x) for d, t in docs for p, x in enumerate((t or "").split("\n"))
        if re.search(r"[^\x20\x09-\x0D]", x)
    )
    first = {}
    for at in places:
        first.setdefault(at[2], at)
    gone = {}
    for at in places:
        if first[at[2]] != at:
            gone[at[:2]] = 1
        elif len(at[2]) >= 20 and any(
            f < at and len(x) >= 20 and x != at[2] and near(x, at[2], 1) for x, f in first.items()
        ):
            gone[at[:2]] = 2
    rows = lines.dedup(odd_docs).collect()
    texts = dict(docs)
    assert len(rows) == odd_docs.count()
    for r in rows:
        key = -1 if r.doc_id is None else r.doc_id
        source = texts[r.doc_id]
        kept = [x for p, x in enumerate((source or "").split("\n")) if (key, p) not in gone]
        assert r.text == (source if source is None else "\n".join(kept))
        assert r.n_exact == sum(v == 1 for k, v in gone.items() if k[0] == key)
        assert r.n_near == sum(v == 2 for k, v in gone.items() if k[0] == key)
    assert lines.dedup(no_docs).count() == 0


def test_bit_parallel_band(spark):
    words = ["", "a", "ab", "abc", "abd", "bc", "xabc", "abcx", "acb", "é", "éb"]
    pairs = spark.createDataFrame([(a, b) for a in words for b in words], "a string, b string")
    for edits in (1, 2):
        split = [F.filter(F.split(c, ""), lambda x: x != "") for c in ("a", "b")]
        for r in pairs.withColumn("ok", lines.within(*split, edits)).collect():
            assert r.ok == near(r.a, r.b, edits), (r.a, r.b, edits)


def test_rules_measure_whole_texts(odd_docs, no_docs):
    rows = rules.judge(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = {r.doc_id: r for r in rows}
    assert (by[3].n_words, by[3].base_failed, by[3].kept) == (0, True, False)
    assert by[6].n_words == by[6].n_repeat_words == 90_000
    assert (by[8].n_words, by[8].word_chars) == (3, 3)
    assert rules.judge(no_docs).count() == 0


def test_a_failing_host_loses_its_documents(spark):
    good = " ".join(f"word{i}" for i in range(40))
    rows = [(i, good if i % 10 == 0 or i >= 100 else "bad", "h1" if i < 100 else "h2") for i in range(300)]
    got = rules.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert {r.doc_id for r in got if r.kept} == set(range(100, 300))


def test_language_of_held_out_documents(spark, sf, odd_docs, no_docs):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.95 * len(got) > 0
    odd = {r.doc_id: r for r in langid.identify(odd_docs).collect()}
    assert odd[3].lang_pred == odd[4].lang_pred == odd[5].lang_pred == "und"
    assert all(0 <= r.score <= 1 for r in odd.values())
    assert langid.identify(no_docs).count() == 0


def _jaccard_by_pairs(docs):
    """Set size and component of each id, all pairs compared."""
    low = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})

    def shingles(text):
        w = [x.translate(low) for x in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
        return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()

    sets = {r.doc_id: shingles(r.text) for r in docs.collect()}
    group = {i: i for i in sets}
    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            a, b = sets[i], sets[j]
            c = len(a & b)
            if a and b and 100 * c >= 75 * (len(a) + len(b) - c) and group[i] != group[j]:
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = {k: new if v == old else v for k, v in group.items()}
    return {i: (len(sets[i]), group[i]) for i in sets}


def _groups(docs):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_groups(docs).collect()}


def _clouds(spark):
    """Texts around three origins, some near each other and some not, and texts with one passage."""
    rng = random.Random(7)
    word = lambda: f"w{rng.randrange(10**6)}"
    passage = [word() for _ in range(40)]
    rows = []
    for origin in range(3):
        base = [word() for _ in range(120)]
        for _ in range(30):
            text = list(base)
            for _ in range(rng.randrange(1, 7)):
                text[rng.randrange(len(text))] = word()
            rows.append(" ".join(text[rng.randrange(12) :]))
    rows += [" ".join([word() for _ in range(rng.randrange(0, 16))] + passage) for _ in range(40)]
    rng.shuffle(rows)
    return spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "doc_id long, text string")


@pytest.mark.parametrize("levels, block", [(2, 600), (0, 600), (0, 1 << 18)])
def test_jaccard_cells_and_blocks_equal_brute_force(spark, monkeypatch, levels, block):
    monkeypatch.setattr(jaccard, "LARGE", 4)
    monkeypatch.setattr(jaccard, "LEVELS", levels)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "MEET", 20)
    docs = _clouds(spark)
    wanted = _jaccard_by_pairs(docs)
    assert 10 < len({c for _, c in wanted.values()}) < 120
    assert _groups(docs) == wanted


def test_jaccard_components_equal_brute_force(spark, sf, odd_docs, no_docs):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert _groups(docs) == _jaccard_by_pairs(docs)
    odd = {r.doc_id: r for r in jaccard.near_groups(odd_docs).collect()}
    assert odd[9].component_id == 8 and odd[4].component_id == 4 and odd[3].n_shingles == 0
    assert jaccard.near_groups(no_docs).count() == 0


def test_mixing_meets_its_targets(odd_docs, no_docs):
    goal = {"en": 0.3, "de": 0.7}
    rows = mixing.mix(odd_docs, {"lang": goal}).collect()
    assert len(rows) == odd_docs.count()
    mass = {v: sum(r.tokens * r.probability for r in rows if r.lang == v) for v in goal}
    for v in goal:
        assert abs(mass[v] / sum(mass.values()) - goal[v]) < 1e-3
    assert mixing.mix(no_docs, {"lang": goal}).count() == 0


def test_mixing_keeps_null_and_unlisted_languages(spark):
    words = "w " * 20
    langs = ["en"] * 60 + ["fr"] * 20 + ["de"] * 10 + ["es"] * 10 + [None] * 40 + ["it"] * 10
    rows = [(i, words, v) for i, v in enumerate(langs)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    goal = {"en": 0.5, "fr": 0.2, "de": 0.2, "es": 0.1}
    got = mixing.mix(docs, {"lang": goal}).collect()
    mass = {v: sum(r.tokens * r.probability for r in got if r.lang == v) for v in [*goal, mixing.OTHER]}
    assert all(r.probability > 0 for r in got)
    assert abs(mass[mixing.OTHER] / sum(mass.values()) - 50 / 150) < 1e-3
    for v in goal:
        assert abs(mass[v] / sum(mass.values()) - goal[v] * 100 / 150) < 1e-3
    # Shares that leave something leave it to the others; values without tokens are drawn too.
    got = mixing.mix(docs, {"lang": {"en": 0.5, "fr": 0.4}}).collect()
    mass = {v: sum(r.tokens * r.probability for r in got if r.lang == v) for v in ["en", "fr", mixing.OTHER]}
    assert abs(mass[mixing.OTHER] / sum(mass.values()) - 0.1) < 1e-3
    empty = docs.withColumn("text", F.when(F.col("lang").isNotNull() & (F.col("lang") != "it"), F.col("text")))
    assert all(r.probability > 0 for r in mixing.mix(empty, {"lang": goal}).collect())


def test_line_dedup_with_more_edits_equals_brute_force(spark, monkeypatch):
    rng = random.Random(3)
    for hot in (lines.HOT_PAIRS, 2):
        monkeypatch.setattr(lines, "HOT_PAIRS", hot)
        found = []
        for size in (45, 60, 90, 92, 240):
            base = "".join(rng.choice("abcdefgh é") for _ in range(size))
            found.append(base)
            for edits in (1, 2, 3, 4):
                line = list(base)
                for _ in range(edits):
                    at = rng.randrange(len(line))
                    line[at : at + 1] = rng.choice([[], ["x"], [line[at], "y"]])
                found.append("".join(line))
        base = "the same line of some thirty letters and a little more, word for word"
        found += [base[:40] + "".join(rng.choice("abc") for _ in range(6)) + base[40:] for _ in range(40)]
        rng.shuffle(found)
        docs = spark.createDataFrame(list(enumerate(found)), "doc_id long, text string")

        def allowed(a, b):
            return max(1, min(lines.MAX_EDITS, min(len(a), len(b)) // lines.CHARS_AN_EDIT))

        want = {
            i for i, x in enumerate(found) if any(near(y, x, allowed(x, y)) for y in found[:i])
        }
        got = {r.doc_id for r in lines.dedup(docs).collect() if r.n_exact + r.n_near}
        assert got == want


def test_parity_bits_are_compared_in_batches(spark):
    """No link is lost by them, sides of any lengths, and no column is walked by interpreted lambdas."""
    rng = np.random.default_rng(5)
    base = np.unique(rng.integers(0, 2**63, 3000, dtype=np.uint64))
    sets = {1: base, 2: base[:2300], 3: base[:40], 4: base[:32], 5: rng.integers(0, 2**63, 2900, dtype=np.uint64)}
    rows = [(k, len(s), jaccard._parity(np.unique(s)).view(np.int64).tolist()) for k, s in sets.items()]
    points = spark.createDataFrame(rows, "name long, n long, parity array<long>")
    pairs = spark.createDataFrame([(a, b) for a in sets for b in sets if a < b], "a long, b long")
    found = jaccard._may_match(points, pairs, 75)
    got = {tuple(r) for r in found.collect()}
    assert {(1, 2), (3, 4)} <= got and (1, 5) not in got
    assert jaccard._may_match(points, pairs.limit(0), 75).count() == 0
    assert "lambdafunction" not in found._jdf.queryExecution().executedPlan().toString()


def test_copies_of_one_line_do_not_meet_in_all_pairs(spark, monkeypatch):
    """A line needs one earlier partner: tables of pairs grow with the lines of a group."""
    stored = {}

    class Counted(lines.WorkTables):
        def __call__(self, df, name):
            df = super().__call__(df, name)
            stored[name] = max(stored.get(name, 0), df.count())
            return df

    monkeypatch.setattr(lines, "WorkTables", Counted)
    base = "the same line of some thirty letters and a little more, word for word, and so on to its end"
    found = [base] + [base[:k] + c + base[k + 1 :] for k in range(60) for c in "VWXY"]
    got = lines.dedup(spark.createDataFrame(list(enumerate(found)), "doc_id long, text string")).collect()
    assert {r.doc_id for r in got if r.n_near} == set(range(1, len(found)))
    most = len(lines.probes(lines.MAX_EDITS)) * len(found)
    assert most < len(found) * (len(found) - 1) / 2
    assert all(n <= most for name, n in stored.items() if name in ("line-pairs", "line-stars", "line-rests")), stored
