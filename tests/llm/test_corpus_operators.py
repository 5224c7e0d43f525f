"""Near-duplicates, suffix dedup, mixing and toxicity against brute force on small tables."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import components, mixing, neardup, queries, suffixdedup, toxicity
from tidemark.llm.suffixsort import Pieces, repeated_windows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def shingles(text, width):
    words = WORD.findall(lower(text))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def plain_components(edges, nodes):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near_texts(seed=1):
    """Groups of near copies, chains of them, copies, and odd texts."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh", k=5))
    rows = []
    for _ in range(6):
        base = [word() for _ in range(rng.randint(30, 90))]
        chain = list(base)
        for _ in range(rng.randint(2, 9)):
            text = list(base)
            for _ in range(rng.randint(0, 3)):
                text[rng.randrange(len(text))] = word()
            rows.append(" ".join(text))
            chain[rng.randrange(len(chain))] = word()
            rows.append(" \n".join(chain).upper())
    rows += [" ".join(word() for _ in range(40)) for _ in range(15)]
    rows += ["one", "one", "one two", "ONE  two", "two one", "", None, " \t", rows[0], rows[0]]
    ids = list(range(100, 100 + len(rows)))
    rng.shuffle(ids)
    return list(zip(ids, rows, strict=True))


def plain_near(rows, width, similar):
    sets = {i: shingles(t, width) for i, t in rows}
    ids = sorted(sets)
    edges = []
    for x, a in enumerate(ids):
        for b in ids[:x]:
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * common >= similar * (len(sets[a]) + len(sets[b]) - common):
                edges.append((a, b))
    found = plain_components(edges, ids)
    return {i: (len(sets[i]), found[i], found[i] == i) for i in ids}


def test_near_duplicates_equal_all_pairs(docs_of, write, spark):
    rows = near_texts()
    folder = write(documents=docs_of(rows))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in queries.QUERIES["op2_minhash_near_dedup"](spark, folder).collect()}
    assert got == plain_near(rows, 3, 85)


def test_near_duplicates_need_several_rounds(docs_of):
    """A bucket full of pairs on either side of the threshold: members that the first centre does not reach are found by later ones."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    base = [word() for _ in range(60)]
    rows = []
    for i in range(80):
        text = list(base)
        for _ in range(rng.choice([1, 2, 3, 4, 5])):
            text[rng.randrange(60)] = word()
        rows.append((i, " ".join(text)))
    setting = neardup.Setting(width=3, similar=80)
    got = {r["id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in neardup.near_duplicates(docs_of(rows), setting).collect()}
    assert got == plain_near(rows, 3, 80)


def test_one_of_each_group(docs_of):
    rows = near_texts(4) + [(500, "lone text of its own kind"), (500, "lone text of its own kind"), (None, "no id at all here"), (None, "")]
    docs = docs_of(rows).withColumnRenamed("lang", "row_key")
    left = neardup.one_of_each(docs, neardup.Setting(width=3, similar=85))
    assert left.columns == docs.columns
    got = collections.Counter((r["doc_id"], r["text"]) for r in left.collect())
    keep = {i for i, v in plain_near(near_texts(4), 3, 85).items() if v[2]}
    want = {(i, t) for i, t in near_texts(4) if i in keep} | {(500, "lone text of its own kind"), (None, "no id at all here"), (None, "")}
    assert set(got) == want and max(got.values()) == 1
    assert neardup.near_duplicates(docs.limit(0)).count() == 0


def test_minima_estimate_similarity():
    import pyarrow as pa

    a = " ".join(f"w{i}" for i in range(400))
    b = " ".join(f"w{i}" if i % 20 else f"x{i}" for i in range(400))
    setting = neardup.Setting(width=1)
    sets, begin = neardup.shingle_sets(pa.array([a, b, "", None]), 1)
    minimum = neardup.minima(sets, begin, setting)
    assert np.diff(begin).tolist() == [400, 400, 0, 0]
    assert abs((minimum[0] == minimum[1]).mean() - 380 / 420) < 0.12


@pytest.mark.parametrize("similar", [80, 85])
def test_signatures_drop_no_more_links_than_the_bands(similar):
    """The loss at the threshold, by the binomial distribution; one more equal minimum asked for would exceed that of the bands."""
    setting, p = neardup.Setting(similar=similar), similar / 100
    fewer = lambda k: sum(math.comb(128, i) * p**i * (1 - p) ** (128 - i) for i in range(k))
    least, bands = neardup._least_agreement(setting), (1 - p**4) ** 32
    assert least == int(least) and fewer(int(least)) <= bands < fewer(int(least) + 1)


def test_connected_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(60)] + [(rng.randrange(100, 160), rng.randrange(100, 160)) for _ in range(45)] + [(200, k) for k in range(201, 240)] + [(7, 7)]
    got = {r["node"]: r["component"] for r in components.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    nodes = {n for a, b in edges if a != b for n in (a, b)}
    assert got == plain_components([e for e in edges if e[0] != e[1]], nodes)
    assert components.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def plain_removed(rows, length):
    raw = [(i, (t or "").encode()) for i, t in rows]
    seen = collections.Counter(b[k : k + length] for _, b in raw for k in range(len(b) - length + 1))
    out = []
    for i, b in raw:
        gone = np.zeros(len(b), dtype=bool)
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                gone[k : k + length] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out.append((i, len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def repeat_texts(seed=3):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdeé漢", k=rng.randint(1, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(90) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = [text(rng.randint(0, 80))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randint(0, 60)
            parts += [p[a : a + rng.randint(200, 500)], text(rng.randint(0, 40))]
        rows.append((i, " ".join(parts)))
    rows += [(60, "ab" * 700), (61, "for " * 500), (62, rows[5][1]), (63, ""), (64, None), (65, "x" * 399), (66, "x" * 400), (67, "x" * 399 + "y"), (5, rows[5][1])]
    return rows


def test_suffix_dedup_equals_brute_force(docs_of, write, spark):
    rows = repeat_texts()
    folder = write(documents=docs_of(rows))
    got = [tuple(r) for r in queries.QUERIES["op10_suffix_array_dedup"](spark, folder).collect()]
    assert sorted((r[:5] for r in got), key=str) == plain_removed(rows, 400)
    seen, inside = collections.Counter(), []
    for _, t in rows:
        words = WORD.findall(t or "")
        seen.update(tuple(words[i : i + 51]) for i in range(len(words) - 50))
    for i, t in rows:
        words = WORD.findall(t or "")
        n = len({j for k in range(len(words) - 50) if seen[tuple(words[k : k + 51])] > 1 for j in range(k, k + 51)})
        inside.append((i, n, n > 0))
    assert sorted(((r[0], r[5], r[6]) for r in got), key=str) == sorted(inside, key=str)


@pytest.mark.parametrize("limit", [1000, 2])
def test_suffix_dedup_of_short_strings_and_large_groups(docs_of, monkeypatch, limit):
    """Few letters and a short length make many anchors alike; with a low limit every group takes the counting way."""
    monkeypatch.setattr(suffixdedup, "GROUP", limit)
    rng = random.Random(8)
    rows = [(i, "".join(rng.choices("ab", k=rng.randint(0, 90)))) for i in range(40)]
    out = suffixdedup.remove_repeats(docs_of(rows), length=12)
    got = [(r["id"], r["n_bytes"], r["n_removed"], len(r["spans"]), hashlib.sha256(r["kept"]).hexdigest()) for r in out.collect()]
    assert sorted(got, key=str) == plain_removed(rows, 12)


def test_long_texts_come_in_parts(docs_of, monkeypatch):
    monkeypatch.setattr(suffixdedup, "BLOCK_BYTES", 700)
    rows = repeat_texts(6)[:30]
    rows = [(i, " ".join(t for _, t in rows[k : k + 6])) for i, k in enumerate(range(0, 30, 6))]
    import pyarrow as pa

    texts = pa.array([t for _, t in rows])
    windows = collections.Counter()
    for data, offsets, row, begin in suffixdedup._blocks(texts, 400):
        text, low, high, at, _ = suffixdedup.anchored(data, offsets, 400)
        for t, a, z in zip(text, low, high, strict=True):
            windows.update((int(row[t]), int(begin[t] - offsets[t] + w)) for w in range(a, z + 1))
    sizes = [len(t.encode()) for _, t in rows]
    assert windows == collections.Counter((i, w) for i, n in enumerate(sizes) for w in range(n - 399))


def test_sort_is_checked_on_the_bytes(monkeypatch):
    """With a hash that says everything is equal, the result is still right."""
    rng = np.random.default_rng(4)
    body = [bytes(rng.integers(97, 99, 12, dtype=np.uint8)) + b"core" + bytes(rng.integers(97, 99, 12, dtype=np.uint8)) for _ in range(40)]
    body += body[:3]
    wanted = np.ones(len(body), dtype=bool)
    make = lambda: Pieces(body, np.full(len(body), 12), np.zeros(len(body)))
    right = sorted(repeated_windows(make(), 14, wanted))
    plain = {(i, j) for i, a in enumerate(body) for j in range(13) for k, b in enumerate(body) if i != k and a[12 - j : 26 - j] == b[12 - j : 26 - j] and len(a[12 - j : 26 - j]) == 14}
    assert {(i, j) for i, lo, hi in right for j in range(lo, hi + 1)} == {(i, j) for i, j in plain if 12 - j + 14 <= 28}
    broken = make()
    broken.prefix[:] = 0
    assert sorted(repeated_windows(broken, 14, wanted)) == right


def test_texts_without_repeats(docs_of):
    passage = "é漢" * 150
    rows = [(1, "start " + passage + " end"), (2, passage), (3, "clean text"), (4, None), (5, "pre" + passage)]
    docs = docs_of(rows).withColumnRenamed("lang", "cuts")
    left = suffixdedup.without_repeats(docs, 400)
    assert left.columns == docs.columns
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in left.collect()}
    assert got == {1: ("start  end", 10), 3: ("clean text", 10), 4: (None, None), 5: ("pre", 3)}


@pytest.mark.parametrize("n", [51, 55, 65])
def test_passages_of_over_fifty_words(docs_of, spark, n):
    """Passages of at most 394 bytes, between different words and with other blanks; one of 50 words stays."""
    rng = random.Random(n)
    text = lambda n, k: " ".join("".join(rng.choices("abcdefgh", k=k)) for _ in range(n))
    passage, short, unbroken = text(n, 5), text(50, 5), text(1, 450)
    rows = [(i, f"{text(20 + i, 5)} {passage if i else passage.replace(' ', '  ')} {text(25, 5)}") for i in range(4)]
    rows += [(10 + i, f"{text(30, 5)} {short} {text(30, 5)}") for i in range(3)]
    rows += [(20 + i, f"{text(20, 5)} {unbroken} {text(20, 5)}") for i in range(2)] + [(30, "lone " * 40), (31, None)]
    assert len(passage) < 394
    left = {r["doc_id"]: r["text"] for r in corpus_pipeline.remove_repeats(spark, docs_of(rows), None).collect()}
    whole = [i for i, t in rows[:4] if left[i] == t]
    assert len(whole) == 1  # the first occurrence stays
    cut = {i: t.split()[: 20 + i] + t.split()[20 + i + n :] for i, t in rows[:4] if i not in whole}
    assert {i: (left[i] or "").split() for i in cut} == cut
    assert all(left[i] == t for i, t in rows if 10 <= i < 20 or i >= 30)
    assert sorted(unbroken in left[i] for i in (20, 21)) == [False, True]
    assert min(len(left[i]) for i in (20, 21)) in range(231, 239)  # the blanks around it go too


@pytest.mark.parametrize("limit", [1000, 2])
@pytest.mark.parametrize("parts", [1, 4])
def test_first_occurrence_of_each_window_stays(docs_of, monkeypatch, limit, parts):
    """Few letters, so that pieces differ, overlap and repeat in one text; every window but the first of its bytes is told."""
    monkeypatch.setattr(suffixdedup, "GROUP", limit)
    rng = random.Random(limit + parts)
    pool = ["".join(rng.choices("abc", k=rng.randint(5, 60))) for _ in range(12)]
    texts = ["".join(rng.choices(pool, k=rng.randint(0, 3))) for _ in range(40)] + ["ab" * 30, "", "c"]
    rows = neardup.keyed(docs_of(list(enumerate(texts))).repartition(parts), "doc_id", "text")
    key = {r["row_key"]: (r["text"] or "").encode() for r in rows.collect()}
    width, first, got, want = 14, {}, collections.defaultdict(set), collections.defaultdict(set)
    for k in sorted(key):
        for i in range(len(key[k]) - width + 1):
            if first.setdefault(key[k][i : i + width], (k, i)) != (k, i):
                want[k] |= set(range(i, i + width))
    for r in suffixdedup.repeated_stretches(rows, width, keep_first=True).collect():
        got[r["row_key"]] |= set(range(r["start"], r["end"]))
    assert got == want and want


def test_quoted_document_stays_once(spark, docs_of):
    rng = random.Random(9)
    text = lambda n: " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(n))
    quoted = text(120)
    rows = [(1, quoted), (2, f"{text(300)} {quoted} {text(300)}")]
    left = {r["doc_id"]: r["text"] for r in corpus_pipeline.remove_repeats(spark, docs_of(rows), None).collect()}
    assert sum(quoted in (t or "") for t in left.values()) == 1 and 2 in left


def test_repeated_words_equal_brute_force(docs_of):
    """Few words and copies of parts: windows of words that occur again, and those of bytes with few words in them."""
    rng = random.Random(5)
    pool = [" ".join(rng.choices(["a", "bb", "ccc", "é漢"], k=rng.randint(0, 60))) for _ in range(30)]
    texts = [rng.choice(pool) + " \n" + rng.choice(pool) for _ in range(40)] + ["a " * 30, "", " x"]
    rows = neardup.keyed(docs_of(list(enumerate(texts))), "doc_id", "text")
    key = {r["row_key"]: r["text"] for r in rows.collect()}
    width, got, want = 7, collections.defaultdict(set), collections.defaultdict(set)
    for r in suffixdedup.repeated_words(rows, width).collect():
        got[r["row_key"]] |= set(range(r["start"], r["end"]))
    words = {k: WORD.findall(t) for k, t in key.items()}
    seen = collections.Counter(tuple(w[i : i + width]) for w in words.values() for i in range(len(w) - width + 1))
    for k, w in words.items():
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i : i + width])] > 1:
                want[k] |= set(range(i, i + width))
    assert got == want and want
    data = np.frombuffer(b"ab cd e fg  h", np.uint8)
    plain = [len(re.findall(rb"(?<= )[^ ]+(?= )", data.tobytes()[i : i + 6])) for i in range(8)]
    assert suffixdedup.inner_words(data, np.array([0, 13]), 6).tolist() == plain


@pytest.mark.parametrize("limit", [1000, 2])
def test_texts_are_fetched_once_for_bytes_and_words(docs_of, monkeypatch, limit):
    """Both kinds of repeats in one pass over the texts, the same as each alone; bytes of pieces are stored only for large groups."""
    monkeypatch.setattr(suffixdedup, "GROUP", limit)
    rows = neardup.keyed(docs_of(repeat_texts()), "doc_id", "text")
    alone = {(*r, False) for r in suffixdedup.repeated_stretches(rows, 60, 9, keep_first=True).collect()}
    alone |= {(*r, True) for r in suffixdedup.repeated_words(rows, 9, keep_first=True).collect()}
    stored, both, write = collections.defaultdict(list), [], suffixdedup.materialize

    def watched(df, label):
        stored[label].append(df._jdf.queryExecution().executedPlan().toString())
        out = write(df, label)
        both[:] = [out]
        return out

    monkeypatch.setattr(suffixdedup, "materialize", watched)
    suffixdedup.without_repeats(docs_of(repeat_texts()), 60, words=9, keep_first=True).count()
    fetched = "suffix-bodies" if limit == 2 else "suffix-stretches"
    assert [p.count("MapInArrow") for p in stored[fetched]] == [1] and len(stored["suffix-bodies"]) == (limit == 2)
    assert {tuple(r) for r in both[0].collect()} == alone and {r[3] for r in alone} == {False, True}


def plain_targets(sizes, cap=3):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    capped, total = {}, sum(sizes.values())
    while True:
        free = [s for s in order if s not in capped]
        level = (total - sum(capped.values())) / max(1, sum(weight[s] for s in free))
        over = [s for s in free if weight[s] * level > cap * sizes[s]]
        if not over:
            return {s: capped.get(s, weight[s] * level) for s in order}
        capped |= {s: cap * sizes[s] for s in over}


def mixing_rows():
    rng = random.Random(11)
    rows = [(i, "w " * rng.randint(0, 60), rng.choice(["a", "b", "b", "b", "ä", "z", None])) for i in range(1500)]
    rows += [(7000, "hot hot hot", "b")] * 900 + [(8000, "tiny", "c"), (8001, "", "d"), (8002, None, "e"), (None, "a b c", "z")]
    return rows


def test_mixing_meets_its_targets(docs_of, write, spark):
    rows = mixing_rows()
    folder = write(documents=docs_of(rows))
    run = lambda: sorted((tuple(r) for r in queries.QUERIES["op5_source_mixing"](spark, folder).collect()), key=str)
    got = run()
    assert got == run() and len(got) == len(rows)
    size = lambda t: len(WORD.findall(t or ""))
    assert collections.Counter((i, n, s) for i, n, *_, s in got) == collections.Counter((i, size(t), s) for i, t, s in rows)
    sizes = collections.Counter()
    for _, t, s in rows:
        sizes[s] += size(t)
    want = plain_targets(sizes)
    taken = collections.Counter()
    for _, n, whole, target, took, s in got:
        assert whole == sizes[s] and abs(target - want[s]) < 1e-6 * max(1, target)
        assert 0 <= took <= 3 * n and (n == 0 or took % n == 0)
        assert n == 0 or int(target / whole) * n <= took <= (int(target / whole) + 1) * n or abs(target - 3 * whole) < 1e-9
        taken[s] += took
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 30, (s, taken[s], want[s])


def test_mixing_takes_each_document_as_often_as_it_should(docs_of):
    """Over many seeds the mean copies come near the rate, whatever the size of the document."""
    sized = docs_of([(i, None, "a" if i < 600 else "b") for i in range(900)]).select(
        F.col("doc_id").alias("id"), "source", (F.col("doc_id") % 50 + 1).alias("size")
    )
    total = collections.Counter()
    seeds = range(6)
    for seed in seeds:
        for r in mixing.mix(sized, seed=seed, block=64).collect():
            total[(r["source"], r["size"] > 25)] += (r["base"] + r["extra"]) / r["target"] * r["source_size"]
    for (source, _), n in total.items():
        assert abs(n / len(seeds) / (300 if source == "a" else 150) - 1) < 0.2, total


def test_repeated_rows_of_the_mix(docs_of):
    docs = docs_of([(i, "w " * (i % 7), "ab"[i % 2]) for i in range(60)] + [(100, "x y z", "a")] * 20).withColumnRenamed("lang", "size")
    sized = docs.select(F.col("doc_id").alias("id"), "source", mixing.word_count(F.col("text")).alias("size"))
    mixed = mixing.mix(sized)
    out = mixing.repeat_rows(docs, mixed, "doc_id", "text", "source")
    assert out.columns == docs.columns
    got = collections.Counter(r["doc_id"] for r in out.collect())
    want = collections.Counter()
    for r in mixed.collect():
        want[r["id"]] += r["copies_of_row"] * r["base"] + r["extra"]
    assert got == +want
    assert mixing.mix(sized.limit(0)).count() == 0


def toxic_rows(n=900, seed=1):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh", k=3))
    rows, labels = [], []
    for i in range(n):
        toxic = rng.random() < 0.15
        words = [word() for _ in range(rng.randint(20, 80))]
        if toxic:
            for _ in range(5):
                words[rng.randrange(len(words))] = rng.choice(["Scum,", "moron", "idiot!", "trash."])
        rows.append((i, " ".join(words)))
        if rng.random() < 0.7:
            labels.append((i, 1, int(toxic)))
        if toxic:
            rows[-1] = (i, rows[-1][1])
    return rows + [(n, None), (n + 1, ""), (n + 2, " \n")], labels


def test_toxicity_on_held_out_rows(docs_of, write, spark):
    rows, labels = toxic_rows()
    folder = write(documents=docs_of(rows), labels=spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = {r["doc_id"]: r for r in queries.QUERIES["op6_toxicity"](spark, folder).collect()}
    again = {r["doc_id"]: r["score"] for r in queries.QUERIES["op6_toxicity"](spark, folder).collect()}
    assert len(got) == len(rows) and again == {i: r["score"] for i, r in got.items()}
    held = [(r["predicted"], t) for i, _, t in labels if (r := got[i])["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got.values())
    assert np.mean([p == t for p, t in held]) > 0.95
    assert np.mean([p for p, t in held if t]) > 0.9


def test_held_out_labels_are_never_learned(docs_of, write, spark, tmp_path):
    """Turning every held-out label round changes no score."""
    rows, labels = toxic_rows(400)
    docs = docs_of(rows)
    turned = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, q, t in labels]
    scores = []
    for part in (labels, turned):
        model = queries.toxicity_model(docs, spark.createDataFrame(part, "doc_id long, quality int, toxic int"))
        scores.append({r["id"]: r["score"] for r in toxicity.score(docs, model).collect()})
    assert scores[0] == scores[1]


def test_toxicity_without_examples(docs_of, spark):
    docs = docs_of([(1, "a b"), (2, None)]).withColumnRenamed("lang", "score")
    none = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    model = queries.toxicity_model(docs, none)
    assert [r["score"] < 1e-9 for r in toxicity.score(docs, model).collect()] == [True, True]
    assert toxicity.below(docs, model, 0.5).columns == docs.columns
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_confirmed_toxic_documents_go_whatever_they_score(docs_of, write, spark):
    """Documents labelled toxic whose words say nothing of it, and one without a text."""
    rows, labels = toxic_rows(400)
    rows = rows + [(2000 + i, rows[0][1] + f" w{i}") for i in range(5)] + [(2100, None), (None, "no id")]
    labels = [x for x in labels if x[0]] + [(i, 1, 1) for i in (*range(2000, 2005), 2100)]
    folder = write(labels=spark.createDataFrame([*labels, (None, 1, 1), (2001, 1, 1)], "doc_id long, quality int, toxic int"))
    docs = docs_of(rows)
    left = corpus_pipeline.remove_toxic(spark, docs, folder)
    assert left.columns == docs.columns
    ids = [r["doc_id"] for r in left.collect()]
    assert not set(ids) & {i for i, _, t in labels if t} and None in ids and len(ids) == len(set(ids))
    assert len(set(ids) & {i for i, _, t in labels if not t}) > 0.95 * sum(not t for *_, t in labels)


def test_risk_is_non_negative_and_calibrated():
    rng = np.random.default_rng(0)
    row = lambda toxic: (np.unique(np.append(rng.integers(0, 200, 20), rng.integers(200, 204, 3) if toxic else [])).astype(np.int32))
    rows = lambda n, p: [(i, np.ones(len(i), np.float32)) for i in (row(rng.random() < p) for _ in range(n))]
    model = toxicity.fit(rows(400, 1.0), rows(2000, 0.1), 0.1, 8, min_texts=5)
    z = lambda i: 1 / (1 + np.exp(-(model.weights[i].sum() + model.intercept)))
    assert np.mean([z(i) > 0.3 for i, _ in rows(200, 1.0)]) > 0.95 and np.mean([z(i) > 0.3 for i, _ in rows(200, 0.0)]) < 0.05
