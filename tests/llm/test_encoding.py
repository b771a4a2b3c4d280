"""SentencePiece, token store, chat format, mixing, pages, URLs and the pipeline."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from edges import LONG, TEXTS, edge_docs, empty_docs
from tidemark.llm import chat, html_text, mixing, queries, sentencepiece, token_store, url_filter

FOLDER = "/root/testdata/sf0.001"
P = pytest.importorskip("public_tokenizers")
PIECES, BYTES = P.path("piece_bpe_32k.model"), P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


# SentencePiece


def toy():
    words = {"▁": -3.0, "▁a": -1.5, "a": -2.0, "b": -2.0, "ab": -2.5, "▁ab": -4.5, "bb": -2.2, "ba": -9.0, "é": -2.0, ".": -1.0}
    pieces = [("<unk>", 0.0, 0)] + [(f"<0x{k:02X}>", 0.0, sentencepiece.BYTE) for k in range(256)]
    return sentencepiece.Unigram(pieces + [(w, s, sentencepiece.NORMAL) for w, s in words.items()]), words


def brute(text, words, unknown):
    """Best score over all ways to cut the text."""
    if not text:
        return 0.0
    options = [s + brute(text[len(w) :], words, unknown) for w, s in words.items() if text.startswith(w)]
    if text[0] not in words:
        options.append(unknown + brute(text[1:], words, unknown))
    return max(options)


def test_unigram_is_the_best_path():
    model, words = toy()
    for n in range(1, 7):
        for letters in itertools.product("ab é.z", repeat=min(n, 5)):
            text = "".join(letters)
            ids = model.encode(text).tolist()
            unknown_ids = sum(k in model.byte_ids.values() for k in ids)
            got = sum(model.scores[k] for k in ids if k not in model.byte_ids.values()) + unknown_ids * model.unknown
            assert math.isclose(got, brute("▁" + text.replace(" ", "▁"), words, model.unknown))
            assert model.decode(np.array(ids, dtype=np.int32)) == text


def test_one_at_a_time_and_many_agree():
    model = sentencepiece.load(PIECES)
    parts = ["▁the", "▁therhaou", "▁naïve", "日本", "▁x𝕊y", ",", "▁", "▁▁▁", "a" * 40, "…é"]
    assert model.best_many(parts) == [model.best(p) for p in parts]


def test_library_lattice_agrees():
    import sentencepiece as library
    from sentencepiece import sentencepiece_model_pb2 as proto

    spec = proto.ModelProto()
    spec.ParseFromString(open(PIECES, "rb").read())
    spec.trainer_spec.model_type = 1
    theirs = library.SentencePieceProcessor(model_proto=spec.SerializeToString())
    model = sentencepiece.load(PIECES)
    for text in ["the quick brown fox", "Than in ofblethti and", "pour éouque épaan", "Größe über alles", "a, b. c", "x.com/y"]:
        assert model.encode(text).tolist() == theirs.nbest_encode_as_ids(text, 5)[0]


def test_cutting_changes_nothing():
    model = sentencepiece.load(PIECES)
    for text in ["The cat, the dog.\nA new  line", "e.g. x.y,z ...", "tab\there", "…", " lead", "trail "]:
        whole = model.best(sentencepiece.MARK + text.replace(" ", sentencepiece.MARK))
        assert model.encode(text).tolist() == whole


def test_encode_decode_frame(spark, docs):
    rows = sentencepiece.encode_decode(docs, PIECES, keep=["text"]).select("_row.text", "ids", "decoded").collect()
    assert len(rows) == docs.count() and all(r.text == r.decoded and len(r.ids) > 0 for r in rows)
    edges = sentencepiece.encode_decode(edge_docs(spark), PIECES, keep=["text"]).select("_row.text", "ids", "decoded").collect()
    assert all(r.decoded == (r.text or "").replace("▁", " ") for r in edges)
    assert sentencepiece.encode_decode(empty_docs(spark), PIECES).count() == 0


# Token store


def check_store(df):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BYTES)
    rows = sorted(df.select("doc_id", "text").collect(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    expected, start = [], 0
    for doc_id, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        expected.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    assert Counter(map(tuple, token_store.store_and_read(df, BYTES).collect())) == Counter(expected)


def test_token_store_documents(docs):
    check_store(docs)


def test_token_store_edges(spark):
    odd = [(100 + k, t, "en", "a") for k, t in enumerate(["a  b", "   lead", "x\n\n  y", "it's we'll I'M", "a\u00a0b", "<|endoftext|> x", "tab\t\tx ", "end. ,x"])]
    check_store(edge_docs(spark, [*TEXTS, *odd]))


def test_token_store_reads_one_document(spark, docs):
    folder = token_store.new_folder(spark, "test-tokens")
    token_store.write(docs, folder, BYTES)
    blocks = spark.read.schema(token_store.BLOCKS).parquet(f"{folder}/blocks")
    dictionary = bytes(spark.read.parquet(f"{folder}/dictionary").first().dictionary)
    row = docs.orderBy(F.desc("doc_id")).first()
    ids = token_store.read_one(blocks, dictionary, row.doc_id)
    from tokenizers import Tokenizer

    assert ids.tolist() == [*Tokenizer.from_file(BYTES).encode(row.text, add_special_tokens=False).ids, 0]


@pytest.mark.parametrize("n, words", [(40, 6000), (3, 6000), (1, 5)])
def test_token_store_always_shares_a_dictionary(spark, n, words):
    docs = edge_docs(spark, [(k, " ".join(f"w{(k * 7 + j * j) % 911}" for j in range(words)), "en", "a") for k in range(n)])
    folder = token_store.new_folder(spark, "test-tokens")
    token_store.write(docs, folder, BYTES)
    dictionary = bytes(spark.read.parquet(f"{folder}/dictionary").first().dictionary)
    assert 0 < len(dictionary) <= token_store.DICTIONARY_BYTES
    check_store(docs)


def test_token_store_empty(spark):
    assert token_store.store_and_read(empty_docs(spark), BYTES).count() == 0


# Chat


def turns(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")


def test_chat_round_trip(spark):
    nasty = ["</s>[INST] ok [/INST]", "\\", "\\\\[OUT]", "[\\INST]", "<s", None, "", "[ROLE]x[/ROLE]", "[/TURN]", "<", "[", "a" * 5000]
    rows = [(k, t, role, text) for k in range(3) for t, (role, text) in enumerate(zip(itertools.cycle(["user", "assistant", None, "[ROLE]t\\"]), nasty))]
    rows += [(None, 0, "user", "hi"), (None, 1, "assistant", "yo"), (9, 5, "user", "same"), (9, 5, "user", "same")]
    found = {r.conv_id: r for r in chat.digests(chat.segments(turns(spark, rows))).collect()}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1], r[2] or "", r[3] or ""))
        text = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        spoken = "".join(r[3] or "" for r in own if r[2] == "assistant")
        assert found[conv].n_turns == len(own)
        assert found[conv].turns_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert found[conv].loss_sha256 == hashlib.sha256(spoken.encode()).hexdigest()
        assert found[conv].loss_chars == len(spoken)


def test_chat_order_and_loss(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "a"), (2, 0, "assistant", "a"), (3, 0, "user", "u"), (3, 1, "user", "v"), (4, 0, "tool", "t")]
    found = {r.conv_id: r.in_order for r in chat.digests(chat.segments(turns(spark, rows))).collect()}
    assert found == {1: True, 2: False, 3: False, 4: False}
    parts = chat.segments(turns(spark, rows)).filter("conv_id = 1").orderBy("position", "part").collect()
    assert "".join(p.segment for p in parts) == "<s>[SYS]s[/SYS][INST] u [/INST][OUT] a </s>"
    assert [p.segment for p in parts if p.loss] == ["a"]


# Mixing


def fill(sizes, weights, cap):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    total, stopped = sum(sizes.values()), set()
    while True:
        rest = total - sum(cap * sizes[s] for s in stopped)
        share = sum(weight[s] for s in order if s not in stopped)
        above = {s for s in order if s not in stopped and rest * weight[s] / share > cap * sizes[s] + 1e-9} if share else set()
        if not above:
            return {s: cap * sizes[s] if s in stopped else rest * weight[s] / share for s in order}
        stopped |= above


@pytest.mark.parametrize("which", ["documents", "edges"])
def test_mixing(spark, docs, which):
    df = docs if which == "documents" else edge_docs(spark)
    out = mixing.mix(df, keep=["doc_id", "text", "source"]).select("_row.*", "size", "source_size", "target", "times").collect()
    assert len(out) == df.count()
    sizes, taken, largest = Counter(), Counter(), Counter()
    for r in out:
        assert r.size == len((r.text or "").encode().split()) and 0 <= r.times <= 3
        sizes[r.source] += r.size
        taken[r.source] += r.size * r.times
        largest[r.source] = max(largest[r.source], r.size)
    targets = fill(sizes, (5, 2, 1), 3)
    for r in out:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, targets[r.source], abs_tol=1e-6)
    for source in sizes:
        assert abs(taken[source] - targets[source]) <= largest[source] / 2 + 1e-6
    again = mixing.mix(df, keep=["doc_id", "text", "source"]).select("_row.*", "size", "source_size", "target", "times").collect()
    assert Counter(map(str, again)) == Counter(map(str, out))


def test_mixed_rows_and_empty(spark, docs):
    assert mixing.mixed_rows(docs).columns == docs.columns
    assert mixing.mixed_rows(empty_docs(spark)).count() == 0


# Pages


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="page-1">
<header>Top<nav><a href=/>Home</a></nav></header><div class="cookie-notice">We use cookies</div>
<aside>Side text</aside><div class="sidebar">More side</div><form>Name <input></form>
<article class="post-12"><h1>A &amp; B&nbsp;title</h1><p>First   <b>bold
text</b>.<p>Second &lt;tag&gt; &copy; 1 < 2<ul><li>one<li>two</ul><script>var x = "</p>";</script>
<div class="ad">Buy</div><table><tr><td>c1<td>c2</table><section id="comments"><p>A reader says hi</p></section></article>
<footer>Foot</footer></body></html>"""


def test_page_blocks():
    blocks = html_text.blocks_of(PAGE)
    text = html_text.text_below(blocks, "html>body.page-#>article.post-#")
    assert text.split("\n") == ["A & B title", "First bold text.", "Second <tag> © 1 < 2", "one", "two", "c1 c2"]


@pytest.mark.parametrize("page", [None, "", "   ", "plain words", "<", "<p", "<p>open", "</p></div>", "<!-- x", "<div class=>a</div>", "<a href='x>y'>link</a>", "<script>x", "&#0;&bogus;&amp", "<p>" * 3000 + "deep"])
def test_broken_pages(page):
    text = html_text.text_below(html_text.blocks_of(page), "")
    assert isinstance(text, str)


def test_pages_give_their_articles(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    import html

    for r in html_text.extract(pages, keep=["html"]).select("_row.html", "text", "n_chars").collect():
        article = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1]
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split("</?(?:p|h1)>", article)]
        assert r.text == "\n".join(filter(None, parts)) and r.n_chars == len(r.text)


LONG_BODY, ITEM = "many words of the body " * 20, "<li>an item of the long list of this page</li>"
WHOLE = {
    "nested": f"<article><h1>Title</h1><p class=lead>Lead</p><div class=body><p>{LONG_BODY}</p></div></article>",
    "sections": f"<main><section class=a><p>first part</p></section><section class=b><p>{LONG_BODY}</p></section></main>",
    "list": f"<article><p>Before the list</p><ul>{ITEM * 30}</ul><p>After it</p></article>",
    "table": f"<article><p>Before the table</p><table><tbody><tr><td>{LONG_BODY}</td></tr></tbody></table></article>",
    "plain": f"<div class=post><h1>Title</h1><p class=lead>Lead</p><div class=text><p>{LONG_BODY}</p></div></div>",
    "halves": f"<div class=post><div class=one><p>{LONG_BODY}</p></div><div class=two><p>{LONG_BODY * 2}</p></div></div>",
}


def test_whole_articles(spark):
    """Nested bodies, unlike sections, long lists and tables: nothing of the article is lost, nothing around it is kept."""
    import html

    rows = [(n, f"http://{n}.org/{k}", f"<body><nav>Menu</nav><div class=note><p>x</p></div>{page}<footer>End</footer></body>") for n, page in WHOLE.items() for k in range(3)]
    found = html_text.extract(spark.createDataFrame(rows, "name string, url string, html string")).select("_row.name", "text").collect()
    assert len(found) == len(rows)
    for r in found:
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split("</?(?:p|h1|li|td)[^>]*>", WHOLE[r.name])]
        assert r.text == "\n".join(filter(None, parts)), r.name
    for page in WHOLE.values():
        assert len(html_text.text_below(html_text.blocks_of(page), "html>gone").split("\n")) > 1


def test_consensus_overrules_a_page(spark):
    body = "<html><body><div class='main'><p>{}</p></div><div class='extra'><p>{}</p></div></body></html>"
    rows = [(k, "http://h.org/x", body.format("main words " * 30, "little")) for k in range(9)]
    rows += [(9, "http://h.org/y", body.format("short main", "long extra words " * 30)), (10, None, None), (11, "x", "")]
    found = dict(html_text.extract(spark.createDataFrame(rows, "page_id int, url string, html string")).select("_row.page_id", "text").collect())
    assert found[9] == "short main" and found[10] == "" and found[11] == ""
    assert html_text.extract(spark.createDataFrame([], "url string, html string")).count() == 0


# URLs


URLS = [
    ("http://a.com/x", "a.com", "/x", "com/", "allow"),
    ("https://WWW.Example.com/en/1?q#f", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
    ("https://m.example.com/en/", "m.example.com", "/en/", "example.com/en/", "block"),
    ("https://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
    ("http://b.net/es/1", "b.net", "/es/1", "net/es/", "block"),
    ("http://b.net/fr/1#x", "b.net", "/fr/1", "net/fr/", "block"),
    ("http://b.net/es", "b.net", "/es", None, None),
    ("http://a.com?x", "a.com", "", None, None),
    ("no scheme", "", "", None, None),
    (None, "", "", None, None),
    ("", "", "", None, None),
    ("x://y://z/p\nq", "y:", "//z/p\nq", None, None),
    ("http://ÄB.org/É", "Äb.org", "/É", None, None),
    ("http://long.org/" + "a" * 20_000, "long.org", "/" + "a" * 20_000, None, None),
]


def test_url_rules(spark):
    df = spark.createDataFrame([(u, 1) for u, *_ in URLS + URLS], "url string, host int")
    for r in url_filter.judge(df, keep=["url"]).select("_row.url", "host", "path", "rule", "verdict").collect():
        expected = next(x for x in URLS if x[0] == r.url)
        assert (r.host, r.path, r.rule) == expected[1:4]
        assert r.verdict == expected[4] if expected[4] else r.verdict in ("allow", "block")


def test_url_model_separates(spark):
    good = [(f"http://news{k}.com/story/{k}",) for k in range(150)]
    bad = [(f"http://casino{k}.net/es/win-{k}",) for k in range(150)]
    new = [("http://news9.org/story/7",), ("http://casino7.org/es/win-3",)]
    df = spark.createDataFrame(good + bad + new, "url string")
    found = {r.url: r.verdict for r in url_filter.judge(df).filter("rule is null").select("_row.url", "verdict").collect()}
    assert found == {"http://news9.org/story/7": "allow", "http://casino7.org/es/win-3": "block"}


def test_url_model_against_brute_force(spark):
    """Witten-Bell log ratios of all n-grams, and the mean along a URL."""
    yes, no = ["ab.c/x", "ab.c/y", "aa.c/"], ["zz.c/x", "zy.c/q"]
    df = spark.createDataFrame([(u, True) for u in yes] + [(u, False) for u in no], "v string, ok boolean")
    model = url_filter.fit(df, "v", "ok")
    grams = {c: Counter() for c in (True, False)}
    for c, urls in ((True, yes), (False, no)):
        for u in urls:
            padded = "\u0002" * url_filter.ORDER + u + "\u0003"
            for at in range(url_filter.ORDER, len(padded)):
                grams[c].update((k, padded[at - k : at + 1]) for k in range(url_filter.ORDER + 1))
    every = set(grams[True]) | set(grams[False])

    def p(c, k, g):
        below = p(c, k - 1, g[1:]) if k else 1 / sum(o == 0 for o, _ in every)
        seen = {h: n for (o, h), n in grams[c].items() if o == k and h[:-1] == g[:-1]}
        total = sum(seen.values())
        return (seen.get(g, 0) + len(seen) * below) / (total + len(seen)) if total else below

    def ratio(u):
        padded, out = "\u0002" * url_filter.ORDER + u + "\u0003", 0.0
        for at in range(url_filter.ORDER, len(padded)):
            k, g = next((k, padded[at - k : at + 1]) for k in range(url_filter.ORDER, -1, -1) if (k, padded[at - k : at + 1]) in every)
            out += math.log(p(True, k, g) / p(False, k, g))
        return out / (len(padded) - url_filter.ORDER)

    got = dict(df.select("v", url_filter.score(F.col("v"), model)).collect())
    for u in yes + no:
        assert math.isclose(got[u], ratio(u), abs_tol=0.02)


def test_url_model_keeps_every_ngram(spark):
    """More n-grams than a table of fixed size holds: each is a row, and an unseen one backs off to what was seen."""
    pick = random.Random(3)
    urls = ["".join(pick.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=40)) for _ in range(1500)]
    df = spark.createDataFrame([(k, u, k % 2 == 0) for k, u in enumerate(urls)], "k bigint, v string, ok boolean")
    model = url_filter.fit(df, "v", "ok")
    units = {r.gram: r.units for r in model.collect()}
    every = {("\u0002" * 4 + u + "\u0003")[at - k : at + 1] for u in urls for at in range(4, 45) for k in range(5)}
    assert set(units) == every and sum(len(g) == 5 for g in every) > 40_000
    new = ["".join(pick.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=30)) for _ in range(50)] + ["", "\u00e9\u00e9", urls[0]]
    found = url_filter.scores(spark.createDataFrame(list(enumerate(new)), "k bigint, v string"), "v", "k", model).collect()
    assert len(found) == len(new)
    for r in found:
        padded, total = "\u0002" * 4 + r.v + "\u0003", 0
        for at in range(4, len(padded)):
            total += next((units[g] for k in range(4, -1, -1) if (g := padded[at - k : at + 1]) in units), 0)
        assert math.isclose(r.log_ratio, total / url_filter.UNITS / (len(padded) - 4), abs_tol=1e-12)


def test_url_empty(spark):
    assert url_filter.judge(spark.createDataFrame([], "url string")).count() == 0


def test_long_text_is_whole():
    assert len(LONG.split()) == 60_000


# Queries and pipeline


def test_every_operator_has_one_query():
    assert sorted(int(q[2:].split("_")[0]) for q in queries.QUERIES) == list(range(1, 11))


def test_pipeline(spark, docs):
    import corpus_pipeline

    assert [len(corpus_pipeline.STAGES), corpus_pipeline.ORACLE_SQL] == [5, None]
    out = corpus_pipeline.run(spark, FOLDER)
    assert out.columns == [*docs.columns, "ids"]
    known = {(r.doc_id, r.text) for r in docs.collect()}
    rows = out.collect()
    assert rows and all((r.doc_id, r.text) in known for r in rows)
    frame = edge_docs(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, frame, FOLDER)
        assert kept.columns == frame.columns
        assert stage(spark, empty_docs(spark), FOLDER).count() == 0
        kept.count()


def test_token_encoder_joins_new_words(monkeypatch):
    """New words go to the library joined, and a memo of two generations gives what the library gives."""
    monkeypatch.setattr(token_store, "MEMO", 40)
    monkeypatch.setattr(token_store, "STRETCH", 300)
    encode = token_store.Encoder(BYTES)
    pick = random.Random(7)
    units = ["a", "b", " ", " ", " ", "\n", "\t", ".", ",", "'s", "1", "é", "\r", "中", " the", "<|endoftext|>", "　", "x" * 70]
    texts = ["".join(pick.choices(units, k=pick.randint(0, 14))) for _ in range(2000)]
    expected = [encode.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(x, dtype=encode.dtype).tolist() for x in encode.encode_all(texts)] == expected
    words, calls, ids = [f" w{k}" for k in range(1000)], [], encode._ids
    monkeypatch.setattr(encode, "_ids", lambda parts: calls.extend(parts) or ids(parts))
    assert b"".join(encode.encode_all(["".join(words)])) == b"".join(ids(words)) and len(calls) < 10


def test_aged_memo_is_looked_up_and_not_gone_through():
    """New parts are looked up in the aged memo; going through it would cost its whole size for each stretch."""

    class Large(dict):
        def __iter__(self):
            raise AssertionError("gone through")

    encode = token_store.Encoder(BYTES)
    texts = ["the one é 日本 x " + "y" * 90 + ",  end. ", "the two", None, "the end"]
    want = [np.array(e.ids, dtype=encode.dtype).tobytes() for e in encode.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    known = encode._ids([" two", "the"])
    encode.aged = Large({f" filler{k}": b"" for k in range(1000)} | {" two": known[0], "the": known[1]})
    assert list(encode.encode_all(texts)) == want and encode.memo[" two"] == known[0]


def test_worker_holds_one_model():
    """A stage's model is let go when the next stage loads its own, before that is loaded."""
    import weakref

    from tidemark.llm.worker import held

    class Thing:
        pass

    first = weakref.ref(held(("language", "test"), Thing))
    assert held(("language", "test"), Thing) is first()
    model = sentencepiece.load(PIECES)
    assert first() is None and sentencepiece.load(PIECES) is model


def test_a_batch_holds_each_text_once(spark):
    """Rows that keep their text are sent without a second copy of it; slices of a batch give their own texts."""
    from tidemark.llm.worker import packed_with, texts_of

    docs = edge_docs(spark)
    kept, apart = packed_with(docs, ["doc_id", "text"], "text"), packed_with(docs, ["doc_id"], "text")
    assert (kept.columns, apart.columns) == (["_row"], ["_row", "_text"])
    texts = [r.text for r in docs.collect()]
    for df in (kept, apart):
        batches = df.toArrow().combine_chunks().to_batches()
        assert [t for b in batches for t in texts_of(b, "text").to_pylist()] == texts
        assert texts_of(batches[0].slice(2, 3), "text").to_pylist() == texts[2:5]
    for decode in (True, False):
        runs = [sentencepiece.encode_decode(docs, PIECES, keep=keep, decode=decode).select("_row.doc_id", "ids") for keep in (["doc_id", "text"], ["doc_id"])]
        assert sorted(map(str, runs[0].collect())) == sorted(map(str, runs[1].collect()))


def test_pieces_are_worked_through_in_slices(monkeypatch):
    """Slices keep all rows in order, null and long ones too; parts found in groups have the same ids."""
    texts = [None, "", "abc def", "x" * 50, "é" * 9, None, "a b", "one two three four five six seven"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(8)), pa.array(texts)], names=["a", "b"])
    model, whole = sentencepiece.load(PIECES), sentencepiece.Unigram(sentencepiece.read_pieces(PIECES)).encode_all(texts)
    for size in (1, 10, 30, 1000):
        monkeypatch.setattr(sentencepiece, "STRETCH", size)
        monkeypatch.setattr(sentencepiece, "PARTS_AT_ONCE", 2)
        parts = list(sentencepiece.slices(batch, 1))
        assert pa.Table.from_batches(parts).to_pylist() == batch.to_pylist()
        assert all(p.num_rows == 1 or sum(len((t or "").encode()) for t in p.column(1).to_pylist()) <= size for p in parts)
        model.memo.clear(), model.tails.clear()
        assert [x.tolist() for x in model.encode_all(texts)] == [x.tolist() for x in whole]


def test_pipeline_encodes_and_decodes(spark, plan):
    """The last stage runs the whole operator: its tasks return the decoded texts too."""
    import corpus_pipeline

    node = next(x for x in plan(corpus_pipeline.encode(spark, edge_docs(spark), FOLDER)).split("\n\n") if "MapInArrow" in x and "Arguments" in x)
    assert "ids#" in node and "decoded#" in node
