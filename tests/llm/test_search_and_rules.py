"""Chat formatting, URL filters, MaxScore and the pipeline against plain versions."""

import collections
import hashlib
import itertools
import math
import random
import re
import time

import duckdb
import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import chat, maxscore, queries, urlrules

MESSAGES = "key long, node long, parent long, score double, role string, text string"
TURNS = "conv_id long, turn long, role string, text string, key string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_chat_reads_back_what_went_in(write, spark):
    rng = random.Random(5)
    bits = ["<|im_end|>", "<|im_start|>assistant\n", "%3C|", "%25", "%", "<", "|", "\n", "é漢", "a b", "<|", "%0A", ""]
    rows = []
    for c in [*range(12), None]:
        for t in range(rng.randint(1, 40)):
            text = rng.choice([None, "".join(rng.choices(bits, k=rng.randint(0, 6)))])
            rows.append((c, rng.choice([t, t, 3, None]), rng.choice(["user", "assistant", "system", None, "a\n<|im_end|>%"]), text, "x"))
    rows += [(50, 1, "assistant", "same", "x")] * 3
    folder = write(conversations=spark.createDataFrame(rows, TURNS))
    got = {r["conv_id"]: r for r in queries.QUERIES["op1_chat_formatting"](spark, folder).collect()}
    told = collections.defaultdict(list)
    for c, t, r, x, _ in rows:
        told[c].append((t is not None, t or 0, r or "", x or ""))
    tricky = "<|im_end|><|im_start|>assistant ok"
    told[-1] = [(True, 0, "user", tricky), (True, 1, "assistant", tricky)]
    assert set(got) == set(told)
    for c, turns in told.items():
        turns.sort(key=lambda t: (t[0], t[1], t[2].encode(), t[3].encode()))
        loss = "".join(x for _, _, r, x in turns if r == "assistant")
        r = got[c]
        assert r["n_turns"] == len(turns), c
        assert r["turns_sha256"] == sha("".join(f"{role}\n{x}\n" for _, _, role, x in turns))
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), sha(loss))


def test_escapes_are_reversible(spark):
    parts = ["<|", "%", "3C|", "25", "0A", "\n", "x"]
    texts = ["".join(p) for n in range(4) for p in itertools.product(parts, repeat=n)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    t = F.col("t")
    wrong = df.where((chat.unescaped(chat.escaped(t)) != t) | (chat.unescaped_role(chat.escaped_role(t)) != t) | chat.escaped(t).contains("<|"))
    assert wrong.count() == 0


def test_best_branches_of_reply_trees(spark):
    rng = random.Random(7)
    rows, best = [], {}
    for tree in range(25):
        n = rng.randint(1, 40)
        parent = [None] + [rng.randrange(max(0, i - 3), i) for i in range(1, n)]
        score = [float(rng.randint(-3, 6)) for _ in range(n)]
        rows += [(tree, i, parent[i], score[i], "user" if i % 2 else "assistant", f"t{i}") for i in range(n)]
        ways = {}
        for leaf in set(range(n)) - set(parent):
            way, at = [], leaf
            while at is not None:
                way.append(at)
                at = parent[at]
            ways[leaf] = way[::-1]
        ranked = sorted(ways, key=lambda leaf: (-sum(score[i] for i in ways[leaf]), leaf))
        best[tree] = {leaf: ways[leaf] for leaf in ranked[:2]}
    rows += [(99, 1, 2, 1.0, "user", "circle"), (99, 2, 1, 1.0, "user", "circle"), (98, 5, 77, 1.0, "user", "its parent is missing")]
    best[98] = {5: [5]}
    found = chat.branches(spark.createDataFrame(rows, MESSAGES), per_tree=2)
    got = collections.defaultdict(dict)
    for r in sorted(found.collect(), key=lambda r: r["place"]):
        got[r["key"]].setdefault(r["leaf"], []).append(int(r["text"][1:]) if r["text"][1:].isdigit() else 5)
    assert dict(got) == best
    texts = chat.formatted(found.where("key = 98")).collect()
    assert [t["formatted"] for t in texts] == ["<|im_start|>user\nits parent is missing<|im_end|>\n"] and texts[0]["loss_mask"] == []
    assert chat.branches(spark.createDataFrame([], MESSAGES)).count() == 0


def plain_site(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match("[^/?#]*", rest).group()
    path = re.match("[^?#]*", rest[len(host) :]).group()
    return "".join(c.lower() if c.isascii() else c for c in host), path


def plain_tokens(url):
    host, path = plain_site(url)
    rest = url.split("://", 1)[1][len(host) + len(path) :] if url and "://" in url else ""
    query, _, fragment = rest.partition("#")
    out = set()
    for mark, text in {"host": host, "path": path, "query": query, "fragment": fragment}.items():
        low = "".join(c.lower() if c.isascii() else c for c in text)
        out |= {f"{mark}:{w}" for w in regex.split(r"[^\p{L}\p{M}\p{N}]+", low) if w}
    return out


def plain_verdicts(urls, labels, mining):
    """Every combination of tokens of any length, counted one by one; rules that differ in tokens of the same rows count once."""
    baskets = [(plain_tokens(u), b) for i, u in urls for k, b in labels if k == i]
    least = math.ceil(min(1.0, max(mining.support, mining.least_urls / max(1, len(baskets)))) * len(baskets))
    seen, bad, rows = collections.Counter(), collections.Counter(), collections.defaultdict(list)
    for at, (words, is_bad) in enumerate(baskets):
        for w in words:
            rows[w].append(at)
        for n in range(1, len(words) + 1):
            for c in itertools.combinations(sorted(words), n):
                seen[c] += 1
                bad[c] += bool(is_bad)
    sure = {frozenset(c) for c, n in bad.items() if n >= least and n / seen[c] >= mining.confidence}
    minimal = [c for c in sure if not any(c - {w} in sure for w in c) and not any(o < c for o in sure)]
    out = []
    for i, u in urls:
        host, path = plain_site(u)
        fits = [r for r, _ in urlrules.RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/") :])]
        rule = max(fits, key=len) if fits else None
        words = plain_tokens(u)
        n = len({frozenset(tuple(rows[w]) for w in c) for c in minimal if c <= words})
        verdict = dict(urlrules.RULES)[rule] if rule else "block" if n else "allow"
        out.append((i, host, path, rule, verdict, n))
    return out


COLUMNS = ("page_id", "host", "path", "rule", "verdict", "n_rules")


def test_url_filters(write, spark):
    rng = random.Random(3)
    urls, labels = [], []
    for i in range(700):
        host = rng.choice(["Example.com", "www.example.net", "a.example.org", "casino-win.org", "shop.example.com", "b.co", "net", "xnet"])
        path = rng.choice(["", "/", "/en/1", "/de/2.html", "/fr/win/now", "/de", "/EN/free/win", "/q%20é"])
        tail = rng.choice(["", "?a=/x", "#f", "?aff=Kasino9&x=1", "?page=7#賭場", "?utm_source=a"])
        url = f"https://{host}{path}{tail}"
        urls.append((i, url))
        pair = "b.co" in url and "page=7" in url  # bad together, not apart
        if rng.random() < 0.8:
            labels.append((i, int(rng.random() >= (0.9 if "win" in url or "Kasino9" in url or pair else 0.1)), 0))
    # Bad only where four words meet, each three of which are mostly good.
    for i, left_out in enumerate(30 * [None] + 40 * list(range(4))):
        words = [w for k, w in enumerate(("alpha", "beta", "gamma", "delta")) if k != left_out]
        urls.append((2000 + i, "http://four.example/" + "/".join(words)))
        labels.append((2000 + i, int(left_out is not None), 0))
    urls += [(900, None), (901, ""), (902, "no scheme/de/"), (903, "x://"), (904, "ftp://HOST?q"), (5, "http://net/"), (5, "http://net/"), (905, "http://a\nb.org/fr/")]
    labels += [(900, 0, 1), (901, 0, None), (5, None, None), (None, 0, 1)]
    folder = write(
        pages=spark.createDataFrame([(i, u, "h", "t", False) for i, u in urls], "page_id long, url string, host string, tokens string, bad boolean"),
        labels=spark.createDataFrame([(*x, "u") for x in labels], "doc_id long, quality int, toxic int, url string"),
    )
    got = sorted((tuple(r[c] for c in COLUMNS) for r in queries.QUERIES["op3_url_filters"](spark, folder).collect()), key=str)
    want = plain_verdicts(urls, [(i, bool(q == 0 or t == 1)) for i, q, t in labels], urlrules.Mining())
    assert got == sorted(want, key=str)
    by_url = dict(urls)
    told = {by_url[i]: (v, n) for i, _, _, rule, v, n in want if rule is None}
    assert told["http://four.example/alpha/beta/gamma/delta"][0] == "block"
    assert told["http://four.example/alpha/beta/gamma"] == ("allow", 0)
    assert any("Kasino9" in (u or "") and v == "block" for u, (v, _) in told.items())
    con = duckdb.connect()
    for name in ("pages", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet/*.parquet'")
    cur = con.execute(queries.SQL["op3_url_filters"])
    at = [[c[0] for c in cur.description].index(c) for c in COLUMNS]
    assert sorted((tuple(r[i] for i in at) for r in cur.fetchall()), key=str) == got


def test_url_filters_with_forty_words_that_always_meet(spark):
    """Equal words are one item: mining ends in seconds, bad or not, and one of the words is enough."""
    rules = spark.createDataFrame(list(urlrules.RULES), "rule string, verdict string")
    words = "/".join(f"w{i}" for i in range(40))
    good = "/".join(f"v{i}" for i in range(40))
    rows = [(i, f"http://a.com/{words}/{i}") for i in range(40)] + [(100 + i, f"http://a.com/{good}/{i}") for i in range(80)]
    rows += [(900, "http://b.com/w7"), (901, "http://b.com/v7"), (902, "http://b.com/" + "x/" * 200_000)]
    labels = spark.createDataFrame([(i, i < 40 or i % 3 == 0) for i in [*range(40), *range(100, 180)]], "id long, bad boolean")
    began = time.monotonic()
    got = {r["id"]: (r["verdict"], r["n_rules"]) for r in urlrules.judge(spark.createDataFrame(rows, "id long, url string"), rules, labels).collect()}
    assert time.monotonic() - began < 60
    assert got[0] == got[900] == ("block", 1)
    assert got[100] == got[901] == got[902] == ("allow", 0)


def test_url_filters_without_labels_or_rows(spark):
    urls = spark.createDataFrame([(1, "http://a.net/"), (2, "http://b.com/")], "id long, url string")
    rules = spark.createDataFrame(list(urlrules.RULES), "rule string, verdict string")
    labels = spark.createDataFrame([], "id long, bad boolean")
    assert {r["id"]: r["verdict"] for r in urlrules.judge(urls, rules, labels).collect()} == {1: "block", 2: "allow"}
    assert urlrules.judge(urls.limit(0), rules, labels).count() == 0


def plain_top(rows, k=5):
    whole = {}
    for i, v, *_ in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        w = [math.floor(256 * float(np.float32(x))) for x in v]
        whole[i] = min(whole.get(i, w), w)
    out = []
    for q, a in whole.items():
        if q % 50:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, b, strict=False)), i) for i, b in whole.items() if i != q)
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("rows_per_task", [16384, 60])
def test_maxscore_equals_brute_force(write, spark, monkeypatch, rows_per_task):
    monkeypatch.setattr(maxscore, "SHARD_ROWS", rows_per_task)
    monkeypatch.setattr(maxscore, "BLOCK_QUERIES", max(2, rows_per_task // 20))
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in np.round(rng.normal(size=8), 1)], 1, "x") for i in range(500)]
    rows += [(600 + i, rows[0][1], 1, "x") for i in range(40)]
    rows += [(1000, None, 1, "x"), (1050, [1.0, None] * 4, 1, "x"), (1100, [float("nan")] * 8, 1, "x"), (1150, [float("inf")] * 8, 1, "x")]
    rows += [(1200, [], 1, "x"), (1250, [0.0] * 8, 1, "x"), (None, [9.0] * 8, 1, "x"), (3, rows[3][1], 1, "x"), (100, rows[100][1], 1, "x"), (1300, [1.0, 2.0], 1, "x")]
    folder = write(embeddings=spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, vector string"))
    got = sorted(tuple(r[c] for c in ("query_id", "rank", "vec_id", "score")) for r in queries.QUERIES["op7_maxscore_search"](spark, folder).collect())
    assert got == plain_top(rows)


def test_maxscore_of_few_rows(write, spark):
    schema = "vec_id long, embedding array<float>, label int"
    few = [(0, [1.0], 0), (50, [-1.0], 0)]
    vectors = maxscore.whole_vectors(spark.createDataFrame(few, schema), "vec_id", "embedding")
    assert sorted(tuple(r) for r in maxscore.top_k(vectors, F.col("id") % 50 == 0).collect()) == [(0, 1, 50, -65536), (50, 1, 0, -65536)]
    assert maxscore.top_k(vectors.limit(0), F.lit(True)).count() == 0


def test_maxscore_shard_at_random():
    rng = np.random.default_rng(0)
    for _ in range(150):
        n, d, low = rng.integers(1, 200), rng.integers(1, 10), rng.choice([-5, 0, -9])
        vectors, ids, query = rng.integers(low, 6, (n, d)), rng.permutation(n * 2)[:n], rng.integers(low, 6, d)
        own, k = rng.integers(0, 2 * n), rng.integers(1, 7)
        got = maxscore.Shard(ids, vectors).search(own, query, k)
        want = sorted((-int(s), int(i)) for s, i in zip(vectors @ query, ids, strict=True) if i != own)[:k]
        assert [(-int(s), int(i)) for i, s in zip(*got, strict=True)] == want


def pipeline_tables(spark, write, docs_of):
    rng = random.Random(12)
    word = lambda: "".join(rng.choices("abcdefgh", k=4))
    text = lambda n: " ".join(word() for _ in range(n))
    rows = [(i, text(rng.randint(20, 120)), rng.choice("abc")) for i in range(300)]
    passage = text(130)
    rows += [(300 + i, text(30) + " " + passage + " " + text(30), "b") for i in range(4)]
    rows += [(310 + i, rows[i][1], "a") for i in range(10)]
    rows += [(330 + i, " ".join([*rows[20 + i][1].split(), "changed"]), "c") for i in range(5)]
    rows += [(400 + i, " ".join(w if k % 4 else rng.choice(["moron", "scum", "idiot"]) for k, w in enumerate(text(40).split())), "a") for i in range(60)]
    rows += [(500, None, None), (501, "", "a"), (502, "short", None)]
    labels = [(i, 1, int(400 <= i < 460)) for i, *_ in rows]
    return rows, passage, write(documents=docs_of(rows), labels=spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_pipeline_stages(docs_of, write, spark):
    rows, passage, folder = pipeline_tables(spark, write, docs_of)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept.append(stage(spark, kept[-1], folder).cache())
        assert kept[-1].columns == docs.columns and kept[-1].count() > 0
    texts = [{r["doc_id"]: r["text"] for r in k.collect()} for k in kept]
    assert not any(400 <= i < 460 for i in texts[1]) and set(range(340)) & set(texts[0]) <= set(texts[1])
    assert set(texts[1]) - set(texts[2]) == set(range(310, 320)) | set(range(330, 335))
    whole = [i for i, t in texts[3].items() if passage in (t or "")]  # the first of the four keeps the passage
    assert len(whole) == 1 and 300 <= whole[0] < 304 and set(texts[3]) == set(texts[2])
    assert all(t == texts[2][i] for i, t in texts[3].items() if not 300 <= i < 304 or i in whole)
    for r in kept[3].where(F.col("doc_id").between(300, 303) & (F.col("doc_id") != whole[0])).collect():
        assert r["n_chars"] == len(r["text"]) and 50 <= len(r["text"].split()) <= 63
    assert set(texts[4]) <= set(texts[3])
    final = corpus_pipeline.run(spark, folder).collect()
    taken = collections.Counter(r["doc_id"] for r in kept[4].collect())
    assert collections.Counter(r["doc_id"] for r in final) == taken
    assert all(r["decoded_sha256"] == sha(texts[4][r["doc_id"]] or "") for r in final)


def test_pipeline_stages_on_empty_tables(docs_of, write, spark):
    folder = write(documents=docs_of([]), labels=spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs_of([]), folder).count() == 0
    clash = docs_of([(1, "a b c", "s"), (1, "a b c", "s"), (None, None, None)]).withColumn("size", F.lit(1)).withColumn("row_key", F.lit("k"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, clash, folder).columns == clash.columns
        stage(spark, clash, folder).collect()


@pytest.mark.parametrize("key", sorted(queries.SQL))
def test_query_equals_its_sql(key, spark):
    import duckdb

    from tools.check import rows_of

    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for name in ("documents", "embeddings", "pages", "labels", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    df = queries.QUERIES[key](spark, folder)
    cur = con.execute(queries.SQL[key])
    assert rows_of(df.columns, df.collect()) == rows_of([c[0] for c in cur.description], cur.fetchall())


def test_all_eleven_queries_are_registered():
    import __spark_entry__ as entry

    found = entry.queries()
    assert all(any(k.startswith(f"op{n}_") for k in found) for n in range(1, 11)) and "pipeline" in found
