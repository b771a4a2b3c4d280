"""License scans, Merkle manifests and lexical search against brute force and awkward rows."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from edges import TEXTS, edge_docs, empty_docs
from tidemark.llm import lexical_search, license_scan, merkle

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ASCII_LOWER = str.maketrans(UPPER, LOWER)


# ---- license scans


def license_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(ASCII_LOWER))


def brute_licenses(text, share=0.8):
    words = license_words(text)
    places, base = [], set()
    for phrase, label in license_scan.PHRASES.items():
        size = len(phrase.split())
        at = [k for k in range(len(words) - size + 1) if words[k : k + size] == phrase.split()]
        places += at
        base |= {label} if at else set()
    span = max(len(t.text.split()) for t in license_scan.TEMPLATES)
    more, best = set(), 0.0
    for start in range(0, max(len(words) - span, 1), span):
        block = set(words[start : start + 2 * span])
        for t in license_scan.TEMPLATES:
            common = len(block & set(t.tokens))
            if common >= math.ceil(share * len(t.tokens) - 1e-9):
                more.add(t.label)
                best = max(best, common / len(t.tokens))
    score = 1.0 if base else best
    ends = (min(places), max(places)) if places else (None, None)
    return len(words), len(places), *ends, ",".join(sorted(base)), ",".join(sorted(base | more)), score


MIT = license_scan.TEMPLATES[0].text
NOTICES = [
    "Released under the MIT License. Released under the MIT License.",
    "cc by nc cc-by-nc CC/BY/NC", "x " * 70 + MIT + " y" * 70, MIT.upper().replace(" ", "\n * "),
    " ".join(MIT.split()[:16]), " ".join(w for k, w in enumerate(MIT.split()) if k % 4),
    "This work is licensed\nunder the GNU\nGeneral Public License, version 3.", "under the MİT license; under the mit licKense",
    "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
    " ".join(t.text for t in license_scan.TEMPLATES),
]
LICENSE_COLUMNS = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]


def test_license_scan_is_brute_force(spark):
    rows = TEXTS + [(100 + k, t, "en", "s") for k, t in enumerate(NOTICES)] + [(200 + k, NOTICES[2], "en", "s") for k in range(40)]
    out = license_scan.scan(edge_docs(spark, rows), keep=["doc_id", "text", "score", "_row"])
    found = out.select("_row.doc_id", "_row.text", *LICENSE_COLUMNS).collect()
    assert len(found) == len(rows)
    for _, text, *values in found:
        assert tuple(values) == brute_licenses(text), text
    assert any("mit" in r.labels and not r.base_labels for r in found)


def test_license_scan_of_nothing(spark):
    assert license_scan.scan(empty_docs(spark)).count() == 0


@pytest.mark.parametrize("share", [0.5, 0.7, 1.0])
def test_license_filters_lose_nothing(spark, share):
    """Shuffled and thinned notices, at several thresholds."""
    rng = np.random.default_rng(5)
    words = sorted({w for t in license_scan.TEMPLATES for w in t.text.split()} | {"lorem", "ipsum", "dolor"})
    rows = [(k, " ".join(rng.choice(words, size=rng.integers(5, 120))), "en", "s") for k in range(150)]
    for k, t in enumerate(license_scan.TEMPLATES):
        for n in range(6):
            kept = [w for w in t.text.split() if rng.random() > n / 10]
            rows.append((1000 + 10 * k + n, " ".join(rng.permutation(kept)), "en", "s"))
    found = license_scan.scan(edge_docs(spark, rows), share=share, keep=["text"]).select("_row.text", "labels", "score").collect()
    for text, labels, score in found:
        assert (labels, score) == brute_licenses(text, share)[-2:]


# ---- Merkle manifests


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def brute_tree(nodes, at):
    """Top and the siblings of leaf ``at``, level by level, with the place of the leaf's node among them."""
    steps = []
    while len(nodes) > 1:
        start = at - at % 8
        steps.append((nodes[start:at], nodes[at + 1 : start + 8]))
        nodes, at = [h(*nodes[k : k + 8]) for k in range(0, len(nodes), 8)], at // 8
    return nodes[0], steps


def brute_manifest(rows):
    """``rows`` of (doc_id, source, lang, n_chars, text) to the multiset of result rows."""
    groups = {}
    for r in rows:
        changed = (*r[:4], r[4].translate(ASCII_LOWER)) if r[4] and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 else r
        groups.setdefault(r[2], []).append((r[0], leaf(r), leaf(changed)))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in groups.values():
        g.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    subroots = [brute_tree([x[1] for x in groups[g]], 0)[0] for g in names]
    out = []
    for k, g in enumerate(names):
        root, above = brute_tree(subroots, k)
        for at, (doc_id, own, changed) in enumerate(groups[g]):
            subroot, steps = brute_tree([x[1] for x in groups[g]], at)
            top = changed
            for left, right in steps + above:
                top = h(*left, top, *right)
            siblings = [s for left, right in steps + above for s in (*left, *right)]
            out.append((doc_id, own, subroot, root, h(*siblings), top, top == root))
    return Counter(out)


def manifest_rows(df):
    columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return Counter(tuple(r) for r in merkle.prove(df).select(*columns).collect())


def fields_of(df):
    return [tuple(r) for r in df.select("doc_id", "source", "lang", "n_chars", "text").collect()]


def test_manifest_is_brute_force(spark):
    """Awkward rows, groups of 1 to 20 languages, and one with several bundles."""
    df = edge_docs(spark)
    assert manifest_rows(df) == brute_manifest(fields_of(df))
    rows = [(k, f"Text {k} IS här", f"l{min(k % 40, 20)}" if k % 40 else None, "s") for k in range(400)]
    df = edge_docs(spark, rows + rows[:9] + [(None, None, None, None), (None, "X", None, None)])
    assert manifest_rows(df) == brute_manifest(fields_of(df))


def test_manifest_of_several_bundles(spark):
    rows = [(k * 7 % 4500, f"T{k}", "en" if k else "de", "s") for k in range(4500)]
    found = {r.doc_id: r for r in merkle.prove(edge_docs(spark, rows)).collect()}
    en = sorted(r for r in rows if r[2] == "en")
    leaves = [leaf((i, s, la, len(t), t)) for i, t, la, s in en]
    for at in (0, 7, 4095, 4096, 4498):
        subroot, steps = brute_tree(leaves, at)
        (other,) = {r.subroot for r in found.values()} - {subroot}
        doc_id, text = en[at][:2]
        top = leaf((doc_id, "s", "en", len(text), text.translate(ASCII_LOWER) if zlib.crc32(str(doc_id).encode()) % 3 == 0 else text))
        for left, right in steps:
            top = h(*left, top, *right)
        row = found[doc_id]
        assert (row.subroot, row.root) == (subroot, h(other, subroot))
        assert row.proof_sha256 == h(*[s for left, right in steps for s in (*left, *right)], other)
        assert (row.folded_root, row.verified) == (h(other, top), h(other, top) == row.root)
    assert {r.verified for r in found.values()} == {True, False}


def test_manifest_of_one_row_and_none(spark):
    df = edge_docs(spark, [(3, "Only", None, None)])
    assert manifest_rows(df) == brute_manifest(fields_of(df))
    assert merkle.prove(empty_docs(spark)).count() == 0


def test_parent_resumes_its_states():
    children = [h(str(k)) for k in range(5)]
    parent = merkle.Parent(children)
    assert parent.node == h(*children) and len(parent.states) == 5
    for k in range(5):
        assert parent.fold(k, children[k]) == parent.node
        assert parent.fold(k, "x") == h(*children[:k], "x", *children[k + 1 :])


# ---- lexical search


def search_terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(ASCII_LOWER).translate({}))


def brute_search(docs, items, k):
    counts = [(i, Counter(search_terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, total = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for t, d in df.items()}
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(search_terms(text))
    out = []
    for item, terms in wanted.items():
        scored = []
        for i, c in counts:
            m = 50 + (50 * sum(c.values()) * n_docs) // total
            score = sum(w[t] * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in terms if c[t])
            if score > 0:
                scored.append((-score, i is not None, i or 0))
        out += [(item, rank + 1, i if there else None, -s) for rank, (s, there, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def searched(spark, docs, items, k=50, **sizes):
    frame = spark.createDataFrame(items, "item_id bigint, text string, score int, terms string")
    return sorted((tuple(r) for r in lexical_search.search(lexical_search.build(docs), frame, k).collect()), key=str)


def test_search_is_brute_force_on_awkward_rows(spark):
    items = [(1, "The quick DOG words", 0, ""), (1, "word", 0, ""), (2, None, 0, ""), (3, "größe Größe 日本語のテキスト", 0, ""), (4, "nowhere-to-be-found", 0, ""), (5, " word7 word11 id ", 0, "")]
    want = brute_search([(i, t) for i, t, *_ in TEXTS], [(i, t) for i, t, *_ in items], 50)
    assert searched(spark, edge_docs(spark), items) == want
    assert {r[0] for r in want} == {1, 3, 5}


@pytest.mark.parametrize("postings", [60, 1 << 20])
def test_search_is_brute_force_over_many_blocks(spark, monkeypatch, postings):
    """Small blocks and large ones give the same ranks; ties over blocks stand by id."""
    monkeypatch.setattr(lexical_search, "BLOCK_POSTINGS", postings)
    rng = np.random.default_rng(3)
    words = [f"w{k}" for k in range(60)]
    weights = 1 / np.arange(1, 61)
    texts = [" ".join(rng.choice(words, size=rng.integers(1, 30), p=weights / weights.sum())) for _ in range(300)]
    docs = [(int(i), texts[k % 220], "en", "s") for k, i in enumerate(rng.permutation(300))]
    items = [(k, " ".join(rng.choice(words, size=6)), 0, "") for k in range(20)]
    want = brute_search([(i, t) for i, t, *_ in docs], [(i, t) for i, t, *_ in items], 7)
    assert searched(spark, edge_docs(spark, docs).repartition(3), items, 7) == want


def test_search_of_nothing(spark):
    assert searched(spark, empty_docs(spark), [(1, "word", 0, "")]) == []
    assert searched(spark, edge_docs(spark), []) == []


def test_tree_holds_its_cells():
    rng = np.random.default_rng(1)
    cells = {(int(r), int(c)): int(v) for r, c, v in zip(rng.integers(0, 500, 900), rng.integers(0, 40, 900), rng.integers(1, 10**6, 900))}
    rows, columns = (np.array(x) for x in zip(*cells))
    tree = lexical_search.Tree(lexical_search.build_tree(rows, columns, np.array(list(cells.values())), 9))
    assert tree.top[0] == max(cells.values())
    for r in range(0, 500, 7):
        got = dict((c, s) for s, c in lexical_search.best_documents(tree, np.array([r]), np.array([1]), 100))
        assert got == {c: v for (row, c), v in cells.items() if row == r}
