"""Quality rules, byte-level BPE and HTML extraction against plain versions."""

import collections
import random
import re
from html.parser import HTMLParser

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from tidemark.llm import bpe, htmltext, quality, queries, textblocks

WORD = re.compile(r"[^\x20\x09-\x0D]+")
EDGES = [None, "", " ", "\n\n", "a", "é ü\t漢字 \x0b x", "w " * 40_000, "x" * 70_000, "a b c d e " * 30, "\x1c\x85  a"]


def random_texts(n, seed=5):
    rng = random.Random(seed)
    parts = ["the ", "of\n", "é", "漢字 ", "  ", "\t", "word. ", "# $ ", "a|b ", "1234 ", "don't ", "\r\n", "end.\n"]
    return ["".join(rng.choices(parts, k=rng.randint(0, 120))) for _ in range(n)]


def test_words_of_a_block():
    texts = EDGES + random_texts(200)
    data, offsets = textblocks.as_bytes(pa.array(texts))
    s, e, first = textblocks.word_bounds(data, offsets)
    hashes = textblocks.word_hashes(data, s, e, step=64)
    seen = {}
    for i, t in enumerate(texts):
        mine = [bytes(data[a:b]).decode() for a, b in zip(s[first[i] : first[i + 1]], e[first[i] : first[i + 1]], strict=True)]
        assert mine == WORD.findall(t or "")
        for w, h in zip(mine, hashes[first[i] : first[i + 1]], strict=True):
            assert seen.setdefault(w, h) == h
    assert len(set(map(int, seen.values()))) == len(seen)


def plain_base(text):
    text = text or ""
    words = WORD.findall(text)
    grams = collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {k for i in range(len(words) - 4) if grams[tuple(words[i : i + 5])] > 1 for k in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n, repeats = len(words), len(covered)
    return (
        n,
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        repeats,
        n < 10 or 100 * repeats > 20 * n,
    )


def test_quality_base_counts(docs_of, write, spark):
    texts = EDGES + random_texts(150) + [random_texts(1)[0]] * 3
    folder = write(documents=docs_of(list(enumerate(texts))))
    rows = {r["doc_id"]: r for r in queries.QUERIES["op4_quality_rules"](spark, folder).collect()}
    assert len(rows) == len(texts)
    for i, t in enumerate(texts):
        r = rows[i]
        got = tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"))
        assert got == plain_base(t), (i, t and t[:50])
        assert not (r["kept"] and r["base_failed"])


@pytest.mark.parametrize(
    ("line", "failure"),
    [
        ("This is a plain sentence of a text.", None),
        ('He said "it works."', None),
        ("A heading", None),
        ("this line of several words has no end", "punctuation"),
        ("Home | News | Contact | Login", "navigation"),
        ("Home News Contact", "navigation"),
        ("This site uses cookies to work.", "boilerplate"),
        ("Copyright 2020, all rights reserved.", "boilerplate"),
    ],
)
def test_line_rules(line, failure):
    assert quality.line_failure(line, quality.LineRules()) == failure


def test_document_verdict_by_lost_text(docs_of):
    good = "\n".join(f"Sentence{i} says{i} something{i} of{i} its{i} own{i} here{i}." for i in range(5))
    bad = "\n".join(f"loose{i} words{i} without{i} any{i} end{i} to{i} them{i} at{i} all{i}" for i in range(9))
    rows = {r["id"]: r for r in quality.clean(docs_of([(1, good), (2, good + "\n" + bad), (3, good + "\nHome News Login")])).collect()}
    assert rows[1]["kept"] and rows[1]["clean_text"] == good and rows[1]["lost_share"] == 0
    assert not rows[2]["base_failed"] and not rows[2]["kept"] and rows[2]["clean_text"] == good and rows[2]["n_removed_lines"] == 9
    assert rows[3]["kept"] and rows[3]["n_removed_lines"] == 1


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(queries.RANK_FILE, queries.PATTERN)


def test_bpe_equals_the_library_and_decodes(docs_of, write, spark, codec):
    texts = EDGES + random_texts(100) + ["<|endoftext|>", "a" * 200_000, " " * 150_000 + "x", ("ab cd\n" * 40_000), "don't" * 20_000]
    folder = write(documents=docs_of([(i, t) for i, t in enumerate(texts)] + [(0, None)]))
    rows = queries.QUERIES["op8_byte_bpe"](spark, folder).collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == bpe.brute_digests(codec, texts[r["doc_id"]])


def test_bpe_splits_only_at_edges(codec):
    rng = random.Random(3)
    for _ in range(200):
        text = "".join(rng.choices(["ab", " ", "  ", "\n", "1", "'s", "!", "é", " ", "\x1c"], k=60))
        pieces = list(bpe.split_safely(text, 7))
        assert "".join(pieces) == text
        whole = codec._encoding.encode_ordinary(text)
        assert [i for p in pieces for i in codec._encoding.encode_ordinary(p)] == whole


def test_html_layout():
    page = (
        "<!doctype html><title>no</title><style>p{}</style><script>if (a<b) 'x'</script><h1>Head</h1><p>One<br>two<p>three"
        "<ul><li>a<li>b<ol start=3><li>c</ol></ul><div style='display:none'>no<p>no</p></div><div hidden>no</div>"
        "<table><caption>Cap</caption><tr><th>x<th>long<tr><td>yyy<td>1</table><pre>k\n  l</pre>&lt;end&gt;<!-- no"
    )
    assert htmltext.visible_text(page) == (
        "Head\n\nOne\ntwo\n\nthree\n\n- a\n- b\n  3. c\n\nCap\n\nx   | long\nyyy | 1\n\nk\n  l\n\n<end>"
    )


class AllText(HTMLParser):
    """Words outside elements that are never shown, by the standard library's parser."""

    def __init__(self):
        super().__init__()
        self.words, self.hidden = [], []

    def handle_starttag(self, tag, attrs):
        if tag in ("head", "script", "style", "template", "noscript"):
            self.hidden.append(tag)
        elif self.hidden and tag == "body":
            self.hidden.clear()

    def handle_endtag(self, tag):
        if self.hidden and tag == self.hidden[-1]:
            self.hidden.pop()

    def handle_data(self, data):
        if not self.hidden:
            self.words += data.split()


def test_html_loses_no_word(spark):
    """On the given pages: the same letters in the same order as a plain parser sees, but for markers and cell marks."""
    import pyarrow.parquet as pq

    path = "/root/testdata/sf0.001/pages.parquet"
    pages = pq.read_table(path, columns=["page_id", "html"]).to_pylist()
    got = {r["page_id"]: r["text"] for r in queries.QUERIES["op9_html_extraction"](spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(pages)
    for p in pages:
        if re.search(r"hidden|display\s*:\s*none|visibility|<(svg|iframe|dialog|object)", p["html"], re.I):
            continue
        plain = AllText()
        plain.feed(p["html"])
        letters = lambda t: re.sub(r"[^\w]|\d", "", t)
        assert sorted(letters(got[p["page_id"]])) == sorted(letters("".join(plain.words))), p["page_id"]


@pytest.mark.parametrize("page", [None, "", "<", "<p", "a < b", "<table>", "<li>" * 5000, "<div>" * 50_000 + "deep", '<a href="x' * 300])
def test_html_edges(page):
    assert isinstance(htmltext.visible_text(page), str)


def test_text_operators_on_empty_tables_and_clashing_names(docs_of, spark):
    empty = docs_of([])
    assert quality.clean(empty).count() == 0
    assert bpe.encode_table(empty, queries.RANK_FILE, queries.PATTERN).count() == 0
    clash = docs_of([(1, "a b"), (None, None)]).withColumnsRenamed({"lang": "id", "source": "ids", "n_chars": "n_words"})
    assert sorted((r["id"], r["n_words"]) for r in quality.clean(clash).collect() if r["id"]) == [(1, 2)]
    coded = bpe.decode_table(bpe.encode_table(clash, queries.RANK_FILE, queries.PATTERN), queries.RANK_FILE, queries.PATTERN)
    assert {r["id"]: bytes(r["decoded"]) for r in coded.collect()} == {1: b"a b", None: b""}
    pages = spark.createDataFrame([(1, "<p>x", "y"), (None, None, "z")], "page_id long, html string, text string")
    assert {r["id"]: r["text"] for r in htmltext.extract(pages).collect()} == {1: "x", None: ""}
    assert htmltext.extract(pages.limit(0)).count() == 0


def test_gram_hashes_of_short_texts():
    data, offsets = textblocks.as_bytes(pa.array(["a b", "a b c", "", "a", "b a", "a b"]))
    s, e, first = textblocks.word_bounds(data, offsets)
    grams, begin = textblocks.gram_hashes(textblocks.word_hashes(data, s, e), first, 3)
    assert np.diff(begin).tolist() == [1, 1, 0, 1, 1, 1]
    assert grams[0] == grams[-1] and len(set(grams.tolist())) == 4


def test_rank_file_is_a_parameter():
    assert queries.RANK_FILE == public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def test_navigation_share_holds_for_lines_of_any_length():
    rules = quality.LineRules()
    word = sorted(quality.NAVIGATION_WORDS)[0]
    for n in (5, 25, 400):
        assert quality.line_failure(" ".join([word] * n) + ".", rules) == "navigation"


def test_html_cells_that_reach_down():
    """A cell with rowspan keeps its column in the rows below, to the end of its group at most."""
    shown = htmltext.visible_text
    assert shown("<table><tr><td rowspan=2>a<td>b<tr><td>c</table>") == "a | b\n  | c"
    assert shown("<table><tr><td>a<td rowspan=3>bb<td>c<tr><td>d<td>e<tr><td>f</table>") == "a | bb | c\nd |    | e\nf"
    assert shown("<table><tr><td rowspan=2 colspan=2>x<td>y<tr><td>z<tr><td>1<td>2<td>3</table>").split("\n")[1].endswith("| z")
    assert shown("<table><tbody><tr><td rowspan=0>a<td>b<tr><td>c<tbody><tr><td>d<td>e</table>") == "a | b\n  | c\nd | e"
    assert shown("<table><tr><td rowspan=x>a<td rowspan=-1>b<tr><td rowspan=99999999999>c<td>d</table>") == "a | b\nc | d"
    table = htmltext.Table()
    table.rows = [[("a", 1, 3), ("b", 2, 2), ("c", 1, 1)], [("d", 1, 1), ("e", 1, 1)], [("f", 1, 1)]]
    assert table.placed() == [[(0, "a", 1), (1, "b", 2), (3, "c", 1)], [(3, "d", 1), (4, "e", 1)], [(1, "f", 1)]]


def test_html_closed_details_show_their_summary():
    page = "<details{}><summary>More</summary><p>inside</details>end"
    assert htmltext.visible_text(page.format("")) == "More\nend"
    assert "inside" in htmltext.visible_text(page.format(" open"))
