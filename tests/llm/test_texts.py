"""Quality rules, SimHash, language and Order MinHash against brute force and awkward rows."""

import hashlib
import math
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from compare import difference
from edges import TEXTS, edge_docs, empty_docs
from tidemark.llm import components, language, order_minhash, quality, simhash
from tidemark.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def words_of(text):
    return [w.decode() for w in (text or "").encode().split()]


def counts_of(text):
    words = words_of(text)
    lines = [x for x in (text or "").split("\n") if words_of(x)]
    windows = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
    covered = {k + d for k in range(len(words) - 4) if windows[tuple(words[k : k + 5])] > 1 for d in range(5)}
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


@pytest.mark.parametrize("which", ["documents", "edges"])
def test_quality_counts(spark, docs, which):
    df = docs if which == "documents" else edge_docs(spark)
    rows = quality.judge(df, keep=["doc_id", "text"]).select("_row.text", *COUNTS, "base_failed", "kept").collect()
    assert len(rows) == df.count()
    for text, *counts, failed, kept in rows:
        assert tuple(counts) == counts_of(text)
        assert failed == (counts[0] < 10 or 100 * counts[4] > 20 * counts[0])
        assert not (failed and kept)


def test_quality_repeats_of_every_shape(spark):
    texts = ["a b c d e " * 3, "a a a a a a", "x " + "p q r s t " * 2 + "y", "a b c d e f a b c d e", "one two three four"]
    df = edge_docs(spark, [(k, t, "en", "s") for k, t in enumerate(texts)])
    found = {r[0]: r[1] for r in quality.with_counts(df.select("text")).select("text", "n_repeat_words").collect()}
    assert found == {t: counts_of(t)[4] for t in texts}


def test_quality_limits_follow_the_source(spark):
    clean = [(k, f"plain words number {k} in a normal sentence of this source right here", "en", "s") for k in range(300)]
    coded = [(1000 + k, f"a # b # c # d # value {k} and # more # marks in this source", "en", "code") for k in range(300)]
    junk = [(5000, "### $$$ %%% " * 2 + "buy now cheap here today only", "en", "s")]
    df = edge_docs(spark, clean + coded + junk)
    kept = {r[0] for r in quality.judge(df, keep=["doc_id"], min_rows=100).filter("kept").select("_row.doc_id").collect()}
    assert {k for k, *_ in clean} <= kept
    assert 5000 not in kept


@pytest.mark.parametrize("percent", [5, 30, 45])
def test_quality_junk_sets_no_limit(spark, percent):
    """Texts that a source rejects at 5 % of its rows are rejected at 30 and 45 % as well."""
    text = lambda k: f"plain words number {k} in a normal sentence of this source right here"
    bad = lambda k: f"# # # # # # # # # word {k} of this advert"
    clean = [(k, text(k), "en", "s") for k in range(2000)]
    mixed = [(5000 + k, bad(k) if k % 100 < percent else text(k), "en", "t") for k in range(400)]
    kept = {r[0] for r in quality.judge(edge_docs(spark, clean + mixed), keep=["doc_id"]).filter("kept").select("_row.doc_id").collect()}
    assert kept == {i for i, t, *_ in clean + mixed if "#" not in t}


def test_sketch_buckets_hold_their_values(spark):
    values = [0, 1, 63, 64, 65, 127, 128, 1000, 12_345, 999_999]
    df = spark.createDataFrame([(v,) for v in values], "v bigint").select("v", quality.bucket(F.col("v")).alias("b"))
    assert all(b <= v and (v - b) * 32 <= max(v, 1) for v, b in df.collect())


def fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes_of(prints):
    parent = {p: p for p in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    order = sorted(parent)
    for i, a in enumerate(order):
        for b in order[i + 1 :]:
            if (a ^ b).bit_count() <= 3:
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return {p: root(p) for p in order}


def check_simhash(df):
    rows = df.select("doc_id", "text").collect()
    prints = [fingerprint(t) for _, t in rows]
    roots = classes_of(prints)
    least = {}
    for (doc_id, _), p in zip(rows, prints, strict=True):
        if doc_id is not None:
            least[roots[p]] = min(least.get(roots[p], doc_id), doc_id)
    expected = Counter((d, f"{p:016x}", least.get(roots[p])) for (d, _), p in zip(rows, prints, strict=True))
    assert Counter(tuple(r) for r in simhash.near_duplicates(df).collect()) == expected


def test_simhash_documents(docs):
    check_simhash(docs)


def test_simhash_edges(spark):
    check_simhash(edge_docs(spark, [(i, t[:5000] if t else t, la, s) for i, t, la, s in TEXTS]))


def test_simhash_links_at_every_distance(spark):
    """Fingerprints at 0 to 6 bits around many centres, more than one block under a key."""
    import random

    pick = random.Random(5)
    values = set()
    for _ in range(6):
        centre = pick.getrandbits(64)
        values.add(centre)
        for _ in range(220):
            values.add(centre ^ sum(1 << b for b in pick.sample(range(64), pick.randint(1, 6))))
    base = pick.getrandbits(64)
    values |= {base ^ (k << 40) for k in range(700)}  # one key for all: over a block
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fingerprint bigint")
    found = {r[0] % (1 << 64): r[1] % (1 << 64) for r in components.components(simhash.links(df)).collect()}
    roots = classes_of(values)
    groups, expected = {}, {}
    for v in values:
        groups.setdefault(found.get(v, v), set()).add(v)
        expected.setdefault(roots[v], set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_chain_is_never_too_strict():
    """Pigeonring: any two values within the budget have a start all of whose chains hold."""
    import random

    import numpy as np

    pick = random.Random(1)
    for _ in range(500):
        flip = sum(1 << b for b in pick.sample(range(64), pick.randint(0, 3)))
        a, b = np.array([0], dtype=np.int64), np.array([flip], dtype=np.uint64).view(np.int64)
        assert any(simhash.chain_holds(a, b, start)[0] for start in range(simhash.SEGMENTS))


def test_components(spark):
    chain = [(k, k + 1) for k in range(40)] + [(100, 102), (102, 101), (7, 7), (500, 500), (None, 3)]
    found = dict(components.components(spark.createDataFrame(chain, "a bigint, b bigint")).collect())
    assert found == {k: 0 for k in range(41)} | {100: 100, 101: 100, 102: 100, 500: 500}


def test_one_per_group(spark):
    same, other = "same text here", "another text that shares no word with it at all"
    rows = [(3, same, "en", "a"), (1, same, "en", "a"), (1, same, "en", "b"), (None, "x", "en", "a"), (None, "x", "en", "a"), (None, same, "de", "c")]
    rows += [(2, same, "en", "a"), (2, other, "en", "a")]  # one id for two texts: only that in the group goes
    kept = simhash.one_per_group(edge_docs(spark, rows))
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == [("1", same), ("2", other), ("None", "x")]
    assert kept.columns == edge_docs(spark).columns


def test_one_per_group_against_all_pairs(spark):
    docs = edge_docs(spark)
    rows = docs.collect()
    order = lambda r: (r.doc_id is None, r.doc_id or 0, r.text or "")
    groups: list[list] = []
    for row in rows:
        near = [g for g in groups if any((simhash.fingerprint_of(row.text) ^ simhash.fingerprint_of(o.text)).bit_count() <= 3 for o in g)]
        groups = [g for g in groups if g not in near] + [[row, *(o for g in near for o in g)]]
    expected = sorted(order(min(g, key=order)) for g in groups)
    assert sorted(order(r) for r in simhash.one_per_group(docs).collect()) == expected
    assert simhash.one_per_group(docs.limit(0)).collect() == []


def test_language_held_out_accuracy(docs):
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    rows = language.identify(docs, docs.filter(~held), keep=["doc_id", "lang", "text"]).filter(held_out("_row.doc_id")).select("_row.lang", "lang_pred", "score").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def held_out(column):
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(5)) == 0


def test_language_edges(spark):
    df = edge_docs(spark)
    rows = language.identify(df, df, keep=["text"]).select("_row.text", "lang_pred", "score").collect()
    assert len(rows) == len(TEXTS)
    for text, pred, score in rows:
        if not any(c.isalpha() for c in text or ""):
            assert (pred, score) == ("und", 0.0)
        else:
            assert pred in ("en", "de", "xx")
    assert language.identify(df, empty_docs(spark), keep=["text"]).filter("lang_pred <> 'und'").count() == 0


def test_language_stage_rejects_what_was_not_taught(spark, docs):
    """One untaught language and random letters go, long or short; rows in taught languages stay."""
    import random

    import corpus_pipeline

    pick, letters = random.Random(4), "abcdefghijklmnopqrstuvwxyz"
    taught = docs.filter("lang is not null").orderBy("doc_id").collect()
    untaught = sorted({r.lang for r in taught})[-1]
    noise = [" ".join("".join(pick.choices(letters, k=pick.randint(2, 9))) for _ in range(n)) for n in (20, 400)]
    rows = [(r.doc_id, r.text, None if r.lang == untaught else r.lang, r.source) for r in taught] + [(-1 - k, t, None, "x") for k, t in enumerate(noise)]
    kept = {r.doc_id for r in corpus_pipeline.language_id(spark, edge_docs(spark, rows), FOLDER).collect()}
    worded = [r for r in taught if sum(w.isalpha() for w in (r.text or "").split()) >= 10]
    good, strange = [r for r in worded if r.lang != untaught], [r for r in worded if r.lang == untaught]
    assert not {-1, -2} & kept
    assert sum(r.doc_id in kept for r in strange) <= 0.1 * len(strange)
    assert sum(r.doc_id in kept for r in good) >= 0.97 * len(good)


def test_language_learns_from_long_rows(spark):
    """A language whose rows are all longer than the bound is learnt, from whole words."""
    rows = [(1, "gamma delta " * 2000, "xx", "a"), (2, "short words here", "en", "a"), (3, "z" * 20_000, "yy", "a"), (4, "gamma delta gamma", None, "a")]
    df = edge_docs(spark, rows)
    texts = dict(language.sample(df, "doc_id", "text", "lang", 250, 10_000).collect())
    assert set(texts) == {"xx", "en", "yy"} and max(map(len, texts.values())) <= 10_000
    assert set(texts["xx"].split()) == {"gamma", "delta"} and len(texts["xx"]) > 9_990
    found = language.identify(df, df.filter("lang is not null"), keep=["doc_id"]).select("_row.doc_id", "lang_pred").collect()
    assert dict(found)[4] == "xx"


def test_language_backs_off_to_shorter_grams():
    model = language.Model(
        ["a", "b"], {"known": 0}, {"abcde": 1, "fg": 2, "x": 3}, np.array([(-1.0, -9.0), (-1.0, -2.0), (-3.0, -4.0), (-5.0, -6.0)])
    )
    assert model.backoff("zabcdefgx") == ((-1 - 3 - 5) / 3, (-2 - 4 - 6) / 3)
    assert model.backoff("???") == (0.0, 0.0)
    assert model.predict("known")[0] == "a"


def test_language_model_holds_scores_as_plain_numbers(monkeypatch):
    """A unit costs its scores and its place in one table of names, not an object for each score."""
    import tracemalloc

    monkeypatch.setattr(language, "WORD_MEMO", 1000)
    words, grams = {f"w{k}": k for k in range(10_000)}, {f"{k:05d}": 10_000 + k for k in range(40_000)}
    scores = np.random.default_rng(5).normal(size=(50_000, 4))
    tracemalloc.start()
    model = language.Model(["a", "b", "c", "d"], words, grams, scores)
    held = tracemalloc.get_traced_memory()[0] - model.table.nbytes
    tracemalloc.stop()
    assert held < 80 * len(scores)
    assert model.backoff("00007") == tuple(scores[10_007].tolist())




def test_order_minhash_edits_and_neighbours(docs):
    rows = {r.doc_id: r for r in order_minhash.fingerprints(docs).collect()}
    texts = dict(docs.select("doc_id", "text").orderBy("doc_id").collect())
    ids = sorted(texts)
    for at, i in enumerate(ids):
        own, after = texts[i] or "", texts[ids[(at + 1) % len(ids)]] or ""
        quarter = len(own) // 4
        edited = own[: len(own) - quarter] + after[:quarter]
        assert rows[i].n_chars == len(own)
        assert rows[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= rows[i].near_edited <= 1 and 0 <= rows[i].near_next <= 1
    long = [r for r in rows.values() if r.n_chars > 400]
    assert sum(r.near_edited > r.near_next for r in long) >= 0.95 * len(long)
    by_text = {}
    for i, text in texts.items():
        by_text.setdefault(text, set()).add(rows[i].fingerprint)
    assert all(len(x) == 1 for x in by_text.values())
    assert len({r.fingerprint for r in rows.values()}) == len({" ".join(words_of(t)) for t in texts.values()})


def test_order_minhash_sees_order_and_repeats(spark):
    base = " ".join(f"w{k}" for k in range(200))
    swapped = " ".join(f"w{k}" for k in [*range(100, 200), *range(100)])
    texts = [base, swapped, base + " " + base, "", None, "one", "one", base + " end"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, text string")
    marks = order_minhash.with_signature(df, "text", "sig").select("k", "sig")
    pairs = marks.alias("a").join(marks.alias("b"), F.col("a.k") < F.col("b.k"))
    near = {(r[0], r[1]): r[2] for r in pairs.select("a.k", "b.k", order_minhash.likeness(F.col("a.sig"), F.col("b.sig"))).collect()}
    assert near[0, 7] > 0.9 and near[0, 1] < 0.9 and near[0, 2] < near[0, 7]
    assert near[3, 4] == 1.0 and near[5, 6] == 1.0 and near[0, 3] == 0.0


@pytest.mark.parametrize("rows_per_block", [1, 3, 1000])
def test_order_minhash_edges(spark, monkeypatch, rows_per_block):
    """The next row is right over block ends, with a null id first and repeated ids in order."""
    monkeypatch.setattr(order_minhash, "ROWS_PER_BLOCK", rows_per_block)
    rows = sorted(((i, t or "") for i, t, *_ in TEXTS), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    expected = Counter()
    for at, (i, own) in enumerate(rows):
        quarter, after = len(own) // 4, rows[(at + 1) % len(rows)][1]
        expected[i, hashlib.sha256((own[: len(own) - quarter] + after[:quarter]).encode()).hexdigest()] += 1
    found = order_minhash.fingerprints(edge_docs(spark)).select("doc_id", "edited_sha256").collect()
    assert Counter(map(tuple, found)) == expected


def test_empty_tables(spark):
    none = empty_docs(spark)
    assert quality.judge(none, keep=["doc_id"]).count() == 0
    assert simhash.near_duplicates(none).count() == 0
    assert language.identify(none, none, keep=["doc_id"]).count() == 0
    assert order_minhash.fingerprints(none).count() == 0


def test_language_needs_a_letter(spark):
    df = edge_docs(spark, [(1, "½ ² ③ 12", "en", "s"), (2, "plain words", "en", "s"), (3, "wörter² hier", "de", "s"), (4, "Ⅷ ٣", None, "s")])
    found = {r[0]: r[1:] for r in language.identify(df, df.filter("doc_id in (2, 3)"), keep=["doc_id"]).select("_row.doc_id", "lang_pred", "score").collect()}
    assert found[1] == ("und", 0.0) and found[4] == ("und", 0.0)
    assert found[2][0] == "en" and found[3][0] == "de"
    assert language.words_in("Wörter²hier x_y") == ["wörter", "hier", "x", "y"]


def test_language_sample_of_repeated_ids(spark):
    """A third of the rows share an id, hence a hash; the sample stays bounded and the same."""
    rows = [(k if k % 3 else 7, f"word{k} and more", "en", "s") for k in range(1500)]
    df = edge_docs(spark, rows)
    first, again = (sorted(r["text"] for r in language.sample(d, "doc_id", "text", "lang", 50, 100).collect()) for d in (df, df.repartition(7)))
    assert len(first) == 50 and first == again


@pytest.mark.parametrize("percent", [30, 5])
def test_quality_sql_on_a_source_with_junk(spark, tmp_path, percent):
    """Code and SQL give the same verdicts where a source's quartile lies in its junk."""
    text = lambda k: f"plain words number {k} in a normal sentence of this source right here"
    bad = lambda k: f"# # # # # # # # # word {k} of this advert"
    rows = [(k, text(k), "en", "s") for k in range(500)]
    rows += [(5000 + k, bad(k) if k % 100 < percent else text(k), "en", "t") for k in range(400)]
    df = edge_docs(spark, rows).select("doc_id", "text", "lang", "source", "n_chars")
    df.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert difference(QUERIES["op8_quality_rules"](spark, str(tmp_path)), con, SQL["op8_quality_rules"]) is None


def test_language_counts_every_labelled_row(spark):
    """Words at the end of long rows and in any of many rows are learnt, and the limit is that of all rows."""
    long = "filler words " * 1000 + "zanzibar"
    rows = [(k, long if k == 999 else f"plain sentence number and unique{'abcdefghij'[k % 10]} words", "en", "s") for k in range(1000)]
    rows += [(2000, "andere sätze hier", "de", "s"), (2001, "noch ein satz", "de", "s")]
    df = edge_docs(spark, rows)
    units = {(r.kind, r.unit): r for r in language.fit(df).collect()}
    assert (0, "zanzibar") in units and units[0, "plain"].halves == 3 and units[0, "zanzibar"].halves in (1, 2)
    n, other = 999 * 6 + 2001, len({w for k, w in units if k == 0})
    en = sum(1 for k, w in units if k == 0 and w not in "andere sätze hier noch ein satz".split())
    assert units[0, "plain"].langs == ["de", "en"] and other == en + 6
    assert abs(units[0, "plain"].scores[1] - math.log((999 + 0.5) / (n + 0.5 * en))) < 1e-9
    found = language.with_limits(language.identify(df, df)).collect()
    apart = {k: [round(r.known_apart, 4) for r in found if r._row.lang == k] for k in ("en", "de")}
    for r in found:
        low, high = np.percentile(apart[r.lang_pred], (25, 75))
        assert abs(r.known_least - max(0.0, low - language.REACH * max(high - low, language.SPREAD))) < 1e-9
        assert r.known_apart <= r.known + 1e-12
