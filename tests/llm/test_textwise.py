"""Operators that judge each row by itself: tokenizer, language, toxicity, main text."""

import hashlib
import random
import time
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfrisk.llm import bpe, html, langid, queries, toxicity
from tests.llm.texts import SCHEMA, corpus

PATH, PATTERN = public_tokenizers.path(queries.RANKS), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def coder():
    with open(PATH, "rb") as file:
        return bpe.encoding(file.read(), PATTERN)


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("ab1 \n\t'sé \x1c.日"), max_size=60))
def test_pieces_keep_the_tokens(coder, text):
    parts = list(bpe.pieces(text, 4))
    assert "".join(parts) == text
    assert [i for p in parts for i in coder.encode_ordinary(p)] == coder.encode_ordinary(text)


def test_bpe_round_trip(spark, coder):
    texts = [r[1] for r in corpus()] + ["<|endoftext|> as text", "x" * 3000, "long words and 日本語 " * 9000]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(None, "no id", 1)], "doc_id long, text string, ids int")
    coded = bpe.decode(bpe.encode(docs.repartition(3), PATH, PATTERN), PATH, PATTERN).collect()
    assert len(coded) == len(texts) + 1
    for row in coded:
        text = "no id" if row.doc_id is None else texts[row.doc_id] or ""
        assert bytes(row.ids) == np.array(coder.encode_ordinary(text), dtype="<u4").tobytes() and row.n_tokens == len(row.ids) // 4
        assert bytes(row.decoded).decode() == text
    assert bpe.encode(docs.limit(0), PATH, PATTERN).count() == 0


def test_digest_query(spark, coder, tmp_path):
    spark.createDataFrame([(1, "Hello  world"), (2, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.op1_bpe(spark, str(tmp_path)).collect()}
    ids = np.array(coder.encode_ordinary("Hello  world"), dtype="<u4").tobytes()
    assert got[1].ids_sha256 == hashlib.sha256(ids).hexdigest() and got[1].decoded_sha256 == hashlib.sha256(b"Hello  world").hexdigest()
    assert (got[2].n_tokens, got[2].ids_sha256, got[2].decoded_sha256) == (0, hashlib.sha256(b"").hexdigest(), hashlib.sha256(b"").hexdigest())


def escape_code(text: bytes, counts: dict) -> float:
    """Code length by definition: walk from the longest context down."""
    bits, data = 0.0, text
    for i, byte in enumerate(data):
        for k in range(min(langid.ORDER, i), -1, -1):
            seen = counts.get(data[i - k:i])
            if not seen:
                continue
            total, kinds = sum(seen.values()), len(seen)
            if byte in seen:
                bits += np.log2((total + kinds) / seen[byte])
                break
            bits += np.log2((total + kinds) / kinds)
        else:
            bits += 8
    return bits


def test_code_lengths_follow_the_definition():
    rng = random.Random(2)
    trained = {"a": "".join(rng.choice("abcd ") for _ in range(400)).encode(), "b": "".join(rng.choice("abxy ") for _ in range(300)).encode()}
    rows, counts = [], {}
    for number, (lang, data) in enumerate(trained.items()):
        own = counts[lang] = {}
        for k in range(langid.ORDER + 1):
            for i in range(k, len(data)):
                nexts = own.setdefault(data[i - k:i], {})
                nexts[data[i]] = nexts.get(data[i], 0) + 1
        for context, nexts in own.items():
            rows += [(number, len(context) << 32 | int.from_bytes(context, "big") << 8 | byte, n) for byte, n in nexts.items()]
    lang, key, n = (np.array(c, dtype=np.int64) for c in zip(*rows))
    model = langid.Model(["a", "b"], lang, key, n, 10_000)
    for text in (b"abcd ab xy", b"", b"zz abz", trained["a"]):
        got, pieces = model.code_lengths(text), model.code_lengths(text, piece=3)
        # The first bytes have contexts shorter than three.
        expected = [escape_code(text, counts[name]) for name in ("a", "b")]
        assert np.allclose(got, expected, rtol=1e-4) and np.allclose(got, pieces, rtol=1e-5)


def test_a_language_with_few_texts_keeps_its_contexts(monkeypatch):
    """A hundred times as many texts of one language do not push the other's contexts out; the table stays within its bytes."""
    def counted(data, number, times):
        return [(number, k << 32 | int.from_bytes(data[i - k:i], "big") << 8 | data[i], times) for k in range(langid.ORDER + 1) for i in range(k, len(data))]

    rng = random.Random(3)
    much, little = (bytes(rng.choice(letters) for _ in range(400)) for letters in (b"abcdefgh", b"stuvwxyz"))
    lang, key, n = (np.array(c, dtype=np.int64) for c in zip(*counted(much, 0, 100), *counted(little, 1, 1)))
    model = langid.Model(["much", "little"], lang, key, n, 40)
    assert model.code_lengths(little[:50]).argmin() == 1 and model.code_lengths(much[:50]).argmin() == 0
    full = langid.Model(["much", "little"], lang, key, n, 10_000)
    monkeypatch.setattr(langid, "MODEL_BYTES", 20_000)
    tight = langid.Model(["much", "little"], lang, key, n, 10_000)
    assert tight.bits.nbytes <= 20_000 + 4 * tight.symbols * 2 < full.bits.nbytes
    assert tight.code_lengths(little[:50]).argmin() == 1 and tight.code_lengths(much[:50]).argmin() == 0


def test_language_is_told_and_edge_cases(spark):
    rng = random.Random(4)
    stock = {"en": ["the", "and", "water", "house", "with"], "fr": ["été", "maison", "avec", "le", "eau"], "de": ["und", "straße", "mit", "haus", "über"]}
    rows = [(i, " ".join(rng.choice(stock[lang]) for _ in range(rng.randrange(4, 40))), lang) for i, lang in enumerate(rng.choices(list(stock), k=240))]
    docs = spark.createDataFrame(rows + [(900, None, "en"), (901, "12 .. 7", None), (902, "", "fr"), (None, "the water", None)], "doc_id long, text string, lang string")
    model = langid.train(docs.filter(~langid.held_out()))
    got = {r.doc_id: r for r in langid.predict(docs, model).collect()}
    tested = [(i, lang) for i, _, lang in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert tested and all(got[i].held_out and got[i].lang_pred == lang and 0 <= got[i].score <= 1 for i, lang in tested)
    assert [(got[i].lang_pred, got[i].score) for i in (900, 901, 902)] == [("und", 0.0)] * 3
    assert got[None].lang_pred == "en" and not got[None].held_out
    nothing = langid.train(docs.limit(0))
    assert {r.lang_pred for r in langid.predict(docs, nothing).collect()} == {"und"}


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.text("abcdef", max_size=9))
def test_automaton_is_edit_distance(word):
    words, stems = ["abcdef", "fedcb", "abc"], ["bcdefa"]
    got = toxicity.Lexicon(words, stems).match(word)
    near = [min((distance(word, w) for w in words if len(w) >= toxicity.FUZZY_FROM), default=9),
            min((distance(word[:n], s) for s in stems for n in range(len(word) + 1)), default=9)]
    if word in words or any(word.startswith(s) for s in stems):
        assert got == toxicity.PLAIN
    else:
        assert (got > 0) == (min(near) <= 1)


def test_automaton_forgets_states_and_matches_the_same(monkeypatch):
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 12))) for _ in range(400)]
    free, tight = (toxicity.Lexicon(words[:60], words[60:80]) for _ in range(2))
    expected = [free.match(w) for w in words + words]
    monkeypatch.setattr(toxicity, "MOST_STATES", 50)
    assert [tight.match(w) for w in words + words] == expected and len(tight.states) < len(free.states) / 3


def test_very_long_words_and_repeated_labelled_rows(spark):
    """A long word is a term like any other; a labelled document that comes a thousand times counts once."""
    long = "x" * 40
    rows = [(i, f"w{i % 7} {long if i % 3 == 0 else 'plain'} w{i % 11} w{i}") for i in range(400)]
    docs = spark.createDataFrame(rows + [rows[2]] * 1000, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(400)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    assert any(long.startswith(s) for s in model.words + model.stems)
    assert np.allclose(model.weights, toxicity.train(docs.distinct(), labels).weights)
    got = {r.doc_id: r.predicted for r in toxicity.score(docs, model).collect()}
    assert got == {i: int(i % 3 == 0) for i in range(400)}


def test_toxicity(spark):
    rng = random.Random(6)
    plain = [f"w{i}" for i in range(300)]

    def text(n):
        return [rng.choice(plain) for _ in range(n)]

    rows, labels = [], []
    for i in range(900):
        own = text(rng.randrange(20, 60))
        toxic = i % 6 == 0
        if toxic:
            for _ in range(2):
                own.insert(rng.randrange(len(own)), rng.choice(["grobian", "lumpkin", "schuft" + rng.choice(["en", "ig", "lich", "erei", "heit"])]))
        elif i % 6 == 1 and i % 12 == 1:
            own.insert(rng.randrange(len(own)), '"grobian"')
        rows.append((i, " ".join(own)))
        labels.append((i, int(toxic)))
    rows += [(2000, None), (2001, ""), (None, "grobian lumpkin"), (2002, "w1 w2 grobiam lumpkim w3 grobain"), (2003, "GROBIAN! lumpkin")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, features string")
    marked = spark.createDataFrame(labels + [(5, None), (None, 1), (0, 0)], "doc_id long, toxic int")
    model = toxicity.train(docs, marked)
    assert {"grobian", "lumpkin"} <= set(model.words) and any(s.startswith("schuf") for s in model.stems)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    tested = [(i, y) for i, y in labels if got[i].held_out]
    right = np.mean([got[i].predicted == y for i, y in tested])
    assert right > 0.95 and all(0 <= r.score <= 1 for r in got.values())
    assert got[2000].score == got[2001].score < 0.5 and got[2003].predicted == 1 and got[None].predicted == 1
    untrained = toxicity.train(docs, marked.limit(0))
    assert {r.score for r in toxicity.score(docs, untrained, carry=["features"]).collect()} == {0.5}


@pytest.mark.parametrize("text, word, inside", [('he said "you fool" today', "fool", True), ("“fool” he said", "fool", True), ("you fool", "fool", False),
                                                ('"hello" fool "bye"', "fool", False), ("«fool\n»", "fool", False)])
def test_quotation(text, word, inside):
    at = text.index(word)
    assert toxicity.quoted(text, at, at + len(word)) is inside


ARTICLE = "A long sentence, with commas, and more words; it says a lot. Another one follows here, as it should."


@pytest.mark.parametrize("page, expected", [
    ("", ""), ("   ", ""), ("plain words, no tags.", "plain words, no tags."),
    (f"<html><head><title>T</title><style>p{{}}</style></head><body><nav><ul><li><a href='/a'>Home</a></li></ul></nav><article><h1>Head</h1><p>{ARTICLE}</p>"
     f"<p>Second&nbsp;&amp;  third\n line, <b>bold</b>.<br>after</p></article><div class='comments'><p>{ARTICLE}</p></div><footer>&copy; x, y.</footer></body></html>",
     f"Head\n{ARTICLE}\nSecond & third line, bold. after"),
    (f"<div id=menu><a>One</a><a>Two</a></div><div class=post><h2>Head</h2><p>{ARTICLE}<p>{ARTICLE}<ul><li>a, b.<li>c, d.</ul></div><div class='side-bar sidebar'>{ARTICLE}</div>",
     f"Head\n{ARTICLE}\n{ARTICLE}\na, b.\nc, d."),
    (f"<article><p><b>Unclosed, bold.<br><p>{ARTICLE}</p><script>var x = '</p>';</script><form><input>Mail, please.</form></article>", f"Unclosed, bold.\n{ARTICLE}"),
    ("<p>one &lt;tag&gt; &#233;</p><!-- no --><p hidden>not shown, at all.</p>", "one <tag> é"),
])
def test_main_text(page, expected):
    assert html.main_text(page) == expected


@pytest.mark.parametrize("mark", ["content has-sidebar", "no-sidebar", "with-comments", "nav-open"])
def test_class_of_a_wrapper_does_not_empty_the_page(mark):
    page = f"<body><div class='{mark}'><div class=text><p>{ARTICLE}</p><p>{ARTICLE}</p></div><div class=sidebar><p>{ARTICLE}</p></div></div></body>"
    assert html.main_text(page) == f"{ARTICLE}\n{ARTICLE}"


def test_long_comments_beside_a_declared_article_stay_out():
    page = f"<body><article><p>{ARTICLE}</p></article><div class=comments>" + f"<p>{ARTICLE}</p>" * 3 + "</div></body>"
    assert html.main_text(page) == ARTICLE


def test_title_and_lead_above_the_body_stay():
    body = f"<p>{ARTICLE}</p>" * 12
    text = "\n".join([ARTICLE] * 12)
    assert html.main_text(f"<body><div><h1>Title</h1><p>Lead, short.</p><div class=body>{body}</div></div></body>") == f"Title\nLead, short.\n{text}"
    assert html.main_text(f"<body><main><p>Lead, short.</p><article>{body}</article></main></body>") == f"Lead, short.\n{text}"


def test_lists_of_links_inside_an_article_go_by_their_ratio():
    links = "".join(f"<li><a href='/{w}'>{w}</a></li>" for w in ("Share", "Tweet", "Mail"))
    shown = f"<article><h1>Head</h1><p>{ARTICLE}</p><ul>{links}</ul><p>{ARTICLE} <a href='/x'>Link</a></p></article>"
    assert html.main_text(shown) == f"Head\n{ARTICLE}\n{ARTICLE} Link"
    two = shown.replace("<li><a href='/Mail'>Mail</a></li>", "")  # two links are no list
    assert html.main_text(two) == f"Head\n{ARTICLE}\nShare\nTweet\n{ARTICLE} Link"
    told = "".join(f"<li><a href='/{i}'>{ARTICLE}</a></li>" for i in range(3))  # as long and punctuated as the text: content
    assert html.main_text(shown.replace(links, told)).count(ARTICLE) == 5


@pytest.mark.parametrize("page", ["no declared part", "article with links"])
def test_the_ratios_decide(monkeypatch, page):
    """With a constant in their place other text is chosen."""
    if page == "no declared part":
        around = "<div class=a>" + "<p>x</p>" * 30 + f"</div><div class=b><p>{ARTICLE}</p><p>{ARTICLE}</p></div><div class=c>" + "<p>y</p>" * 30 + "</div>"
        expected = f"{ARTICLE}\n{ARTICLE}"
    else:
        around = f"<article><p>{ARTICLE}</p><ul>" + "<li><a>x</a></li>" * 4 + "</ul></article>"
        expected = ARTICLE
    assert html.main_text(around) == expected
    monkeypatch.setattr(html, "fused_ratios", lambda nodes: np.ones(len(nodes)))
    assert html.main_text(around) != expected


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["", "x", "One, two. ", "Longer text, with points; and more! "])), min_size=1, max_size=25))
def test_path_ratios_match_brute_force(found):
    nodes = [html.Node(path, 0, 0, text, True) for path, text in found]
    own = {p: [t for q, t in found if q == p] for p, _ in found}
    length = [sum(len(t.strip()) for t in own[p]) / len(own[p]) for p, _ in found]
    points = [(1 + sum(t.count(c) for t in own[p] for c in ".,;!")) / len(own[p]) for p, _ in found]
    at = lambda v, i: v[min(max(i, 0), len(v) - 1)]
    smooth = [[sum(w * at(v, i + k - 2) for k, w in enumerate((0.06, 0.24, 0.4, 0.24, 0.06))) for i in range(len(v))] for v in (length, points)]
    assert np.allclose(html.fused_ratios(nodes), [(a * b) ** 0.5 for a, b in zip(*smooth)])


@pytest.mark.parametrize("page", ["<div>word, " * 50_000, "<!--" * 50_000, "<a" * 50_000, "<p><td>x</p>" * 20_000, "<div class=nav>z" * 20_000])
def test_deep_and_unclosed_pages_take_linear_time(page):
    start = time.process_time()
    tracemalloc.start()
    html.main_text(page)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 100e6 and time.process_time() - start < 30  # the tracer slows it about six times


def test_pages(spark):
    rows = [(1, "u", "<article><p>x, y.</p></article>", 5), (1, "u", "<article><p>x, y.</p></article>", 5), (None, None, None, 5), (3, "u", "<" * 500 + "p>" + "a " * 100_000, 5)]
    got = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text int")).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in got if r.page_id != 3) == [(0, 0), (1, 5), (1, 5)] and len(got) == 4
