"""Conversation prefix trie, token files and spelling variants against plain Python versions."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import prefixtrie, queries, spelling, tokenfile

TURNS = "conv_id bigint, turn bigint, role string, text string"


# --- prefix trie ----------------------------------------------------------------


def brute_trie(rows, group=20, shared=4):
    given = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            given[c].append(((t is not None, t or 0), role or "", text or ""))
    own = {c: [(role, text) for _, role, text in sorted(v)] for c, v in given.items()}
    built = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % shared
        built[c] = own.get(c - int(math.fmod(c, group)), [])[:h] + v[h:]
    members, kids = defaultdict(list), defaultdict(list)
    for c, v in built.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    for k in members:
        if k:
            kids[k[:-1]].append(k)
    leaves, saved = {}, {}
    for k in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        leaves[k] = sum(leaves[x] for x in kids[k]) or 1
        saved[k] = sum(saved[x] for x in kids[k]) + (len(members[k]) - 1) * words
    out = []
    for k, m in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in m if len(built[c]) == len(k)))
        above = min(members[k[:-1]]) if k else None
        out.append((min(m), len(k), above, len(m), len(kids[k]), leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out)


def trie_of(spark, tmp_path, rows, extra=None):
    df = spark.createDataFrame(rows, TURNS)
    (df if extra is None else extra(df)).repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    return queries.QUERIES["op11_prefix_trie"](spark, str(tmp_path))


def check_trie(spark, tmp_path, rows, extra=None):
    got = trie_of(spark, tmp_path, rows, extra)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(tuple(r) for r in got.collect()) == brute_trie(rows)


def test_trie_of_all_conversations_of_the_small_tables(spark):
    sf_dir = "/root/testdata/sf0.01"
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    got = queries.QUERIES["op11_prefix_trie"](spark, sf_dir)
    assert sorted(tuple(r) for r in got.collect()) == brute_trie([tuple(r) for r in given.collect()])


@pytest.mark.parametrize("seed,longest,variety", [(0, 9, 2), (1, 17, 2), (2, 4, 3), (3, 33, 1)])
def test_trie_of_random_conversations(spark, tmp_path, seed, longest, variety):
    rng = np.random.default_rng(seed)
    rows = []
    for c in rng.choice(np.arange(-45, 300), 60, replace=False).tolist():
        for t in range(int(rng.integers(1, longest + 1))):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", f"word {' more' * int(rng.integers(0, variety))}"))
    check_trie(spark, tmp_path, rows)


def test_trie_with_nulls_empty_texts_ties_repeats_and_copies(spark, tmp_path):
    rows = [(None, 0, "user", "lost"), (3, None, "user", "first"), (3, 0, None, None), (3, 0, "a", ""), (3, 0, "a", ""), (3, 1, "user", "x\ty\nz")]
    rows += [(c, t, "user", "same " * t) for c in range(100, 160) for t in range(5)]  # one common conversation
    rows += [(7, 2**40, "user", "long " * 50_000), (21, 0, "user", ""), (22, 0, None, "only")]
    rows += [(-1, 0, "user", "below zero"), (2**62, 0, "user", "far")]
    check_trie(spark, tmp_path, rows, lambda df: df.withColumns({"conv": F.lit(1), "len": F.lit("x"), "key": F.lit(2), "pos": F.lit(0)}))


def test_conversations_left_without_turns_are_members_of_the_root(spark, tmp_path):
    turnless = [c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 > 0]  # one turn each, no leader
    check_trie(spark, tmp_path, [(c, 0, "user", "gone") for c in turnless])


def test_trie_of_an_empty_table(spark, tmp_path):
    assert trie_of(spark, tmp_path, []).count() == 0


def test_one_long_conversation_is_numbered_over_several_parts(spark):
    rows = spark.range(5000).select(F.lit(1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), F.col("id").cast("string").alias("text"))
    got = prefixtrie.numbered(rows.repartition(7))
    assert sorted(r.pos for r in got.collect()) == list(range(1, 5001))


# --- token files ----------------------------------------------------------------


def brute_places(rows):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.TOKENIZER_FILE)
    library.encode_special_tokens = True
    out, at = [], 0
    for number, text in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")
        out.append((number, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


HARD_TEXTS = [
    None,
    "",
    " ",
    "   \n\t  ",
    "a  b   c\n\n\n d",
    "tail   ",
    "  x    y  z \x1c \x1f! \x85q",
    "it's they'll 'S \r\n\r\n end",
    "<|endoftext|> <|endoftext|>x",
    "naïve café Ünïcode ß 中文字 日本 🙂🙂 é",
    "x" * 70_000,
    ("lorem ipsum 123 " * 20_000) + "end",
    "1234567890 " * 3,
]


def test_encoder_equals_the_library_on_whole_texts():
    encoder = tokenfile.Encoder(queries.TOKENIZER_FILE)
    want = brute_places([(i, t) for i, t in enumerate(HARD_TEXTS)])
    blocks = encoder.encode_block([t or "" for t in HARD_TEXTS])
    again = [encoder.encode(t or "") for t in HARD_TEXTS]
    for (_, _, n, crc), *both in zip(want, blocks, again, strict=True):
        for ids in both:
            assert n == len(ids) + 1 and crc == zlib.crc32(np.append(ids, 2).astype("<u4").tobytes())


def test_encoder_forgets_and_stays_right(monkeypatch):
    monkeypatch.setattr(tokenfile, "REMEMBERED", 20)
    encoder = tokenfile.Encoder(queries.TOKENIZER_FILE)
    rng = np.random.default_rng(5)
    for _ in range(30):
        text = " ".join(f"w{n}" for n in rng.integers(0, 60, 40))
        assert encoder.encode(text).tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert len(encoder._number) <= 20 + 41


def test_pieces_end_before_marks_and_are_shared():
    """Words and the marks behind them are remembered apart, wide white space and signs do not count as letters."""
    encoder = tokenfile.Encoder(queries.TOKENIZER_FILE)
    texts = [f" {w}{m}" for w in ("alpha", "béta", "x9", "×", "a×", "a÷", "日本", "a\u3000", "a\u2003 ", "b\xa0 ", "c\x85 ", "…") for m in ("", ".", ",$$$", "'s", "'ll.", " <|endoftext|>")]
    for text, ids in zip(texts, encoder.encode_block(texts), strict=True):
        assert ids.tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert {b" alpha", " béta".encode(), b" x9", b",$$$"} <= set(encoder._number)
    assert not any(p.startswith(b" alpha") for p in set(encoder._number) - {b" alpha"})
    whole = "".join(texts)
    assert encoder.encode(whole).tolist() == encoder.tokenizer.encode(whole, add_special_tokens=False).ids


def test_places_read_back_from_the_files(spark, tmp_path, docs_of):
    rows = [(i * 7 % 101, t) for i, t in enumerate(HARD_TEXTS * 3)]
    rows = list({r[0]: r for r in rows}.values())
    docs = docs_of(rows).withColumns({"ids": F.lit("clash"), "tie": F.lit(0), "file": F.lit(1), "start": F.lit(2)})
    docs.repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["op12_token_orc"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(tuple(r) for r in got.collect()) == brute_places(sorted(rows, key=lambda r: r[0]))


def test_places_of_null_and_repeated_ids(spark, tmp_path, docs_of):
    rows = [(None, "a b"), (None, "a b"), (1, "x"), (1, "x"), (1, "other words"), (2, None)] + [(3, "same")] * 40
    docs_of(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["op12_token_orc"](spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    by_start = sorted(got, key=lambda r: r.start)
    assert [r.start for r in by_start] == np.cumsum([0] + [r.n_tokens for r in by_start[:-1]]).tolist()
    assert [r.doc_id for r in by_start] == [None, None, 1, 1, 1, 2] + [3] * 40


def test_places_of_an_empty_table(spark, tmp_path, docs_of):
    docs_of([]).write.parquet(f"{tmp_path}/documents.parquet")
    assert queries.QUERIES["op12_token_orc"](spark, str(tmp_path)).count() == 0


def test_files_have_stripes_row_indexes_and_bloom_filters(spark, tmp_path):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.repeat(F.concat(F.lit(" w"), (F.col("id") % 97).cast("string")), 40).alias("text"))
    path = f"{tmp_path}/tokens"
    schema = tokenfile.write(docs, path, queries.TOKENIZER_FILE, layout=tokenfile.Layout(stripe_bytes=1 << 16, index_rows=1000))
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(path)
    files = [f.getPath() for f in folder.getFileSystem(conf).listStatus(folder) if f.getPath().getName().endswith(".orc")]
    kinds, stripes = set(), 0
    for f in files:
        reader = jvm.org.apache.orc.OrcFile.createReader(f, jvm.org.apache.orc.OrcFile.readerOptions(conf))
        stripes += reader.getStripes().size()
        assert reader.getRowIndexStride() == 1000
        rows = reader.rows()
        for i in range(min(1, reader.getStripes().size())):
            footer = rows.readStripeFooter(reader.getStripes().get(i))
            kinds |= {(s.getColumn(), str(s.getKind())) for s in footer.getStreamsList()}
            encodings = {str(c.getKind()) for c in footer.getColumnsList()}
            assert "DIRECT_V2" in encodings  # run-length encoding of whole numbers, second version
        rows.close()
    assert stripes > len(files)
    assert (1, "BLOOM_FILTER_UTF8") in kinds and (1, "ROW_INDEX") in kinds
    found = tokenfile.lookup(spark, path, schema, [5, 19_999])
    assert "PushedFilters: [In(id, [" in found._jdf.queryExecution().toString()
    assert sorted(r.id for r in found.collect()) == [5, 19_999]


# --- spelling variants ----------------------------------------------------------


def brute_variants(rows, letters=6, occurrences=5, ratio=5):
    counts = Counter()
    for number, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if number is None else number}:{w}".encode())
            counts[w[: h % len(w)] + w[h % len(w) + 1 :] if h % 199 == 0 else w] += 1
    n = {w: k for w, k in counts.items() if len(w) >= letters and k >= occurrences}
    near = {w: set() for w in n}
    for a in n:
        for b in n:
            if len(a) == len(b):
                close = sum(x != y for x, y in zip(a, b, strict=True)) == 1
            else:
                close = len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))
            if close:
                near[a].add(b)
                near[b].add(a)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        if best is not None and n[best] >= ratio * n[w]:
            form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return sorted(out)


def word_texts(seed, n_docs, letters="abé", pool=150):
    rng = np.random.default_rng(seed)
    pool = ["".join(rng.choice(list(letters), int(rng.integers(4, 9)))) for _ in range(pool)]
    share = 1 / np.arange(1, len(pool) + 1)
    return [(i, " ".join(rng.choice(pool, 60, p=share / share.sum()))) for i in range(n_docs)]


@pytest.mark.parametrize(
    "setting",
    [spelling.Setting(), spelling.Setting(cell=10, sample=40, leaf=4), spelling.Setting(cell=7, sample=10**6, leaf=1)],
    ids=["production", "many cells, poor sample", "tiny cells and leaves"],
)
def test_variants_against_all_pairs(docs_of, setting):
    rows = [*word_texts(1, 120), (1000, "zzzzab " * 150 + "zzzzaa " * 28 + "zzzzba " * 5)]  # the last word's form has a form
    got = spelling.variants(docs_of(rows).repartition(3), setting)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = brute_variants(rows)
    assert sorted(tuple(r) for r in got.collect()) == want
    assert any(w[1] for w in want) and any(w[2] not in (w[0], w[1]) for w in want)  # forms, and ways of two steps


def test_variants_of_words_with_the_same_letters(docs_of):
    """Anagrams share one vector: they fill a cell that no cut can divide."""
    import itertools

    words = ["".join(p) for p in itertools.islice(itertools.permutations("abcdefg"), 60)]
    rows = [(i, " ".join(words + [w + "h" for w in words[:30]])) for i in range(6)]
    setting = spelling.Setting(cell=8, sample=10**6, leaf=4)
    assert sorted(tuple(r) for r in spelling.variants(docs_of(rows), setting).collect()) == brute_variants(rows)


def test_variants_with_nulls_case_ties_repeats_and_long_words(spark, tmp_path, docs_of):
    long = "ab" * 3000
    text = f"{'common ' * 40} {'Common ' * 10} {'commin ' * 6} commun commun commun commun commun À{'é' * 6} ×÷×÷×÷ {long} {long}x "
    rows = [(1, text)] * 3 + [(2, text), (3, text.upper()), (4, None), (5, ""), (None, text), (6, "short one two"), (7, "sixlet " * 5 + "sixlot " * 5)]
    docs = docs_of(rows).withColumns({"word": F.lit("clash"), "n": F.lit(1), "id": F.lit(0), "length": F.lit(1)})
    docs.repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["op13_spelling_variants"](spark, str(tmp_path))
    assert sorted(tuple(r) for r in got.collect()) == brute_variants(rows)


def test_variants_of_an_empty_table(docs_of):
    assert spelling.variants(docs_of([])).count() == 0


def test_tree_reaches_all_rows_within_the_radius():
    rng = np.random.default_rng(4)
    rows = rng.integers(0, 3, (400, 12)).astype(np.uint8)
    for open_boxes in (False, True):
        tree = spelling.Tree(rows, 8, open_boxes)
        leaf = tree.leaf_of(rows)
        for number, members in enumerate(tree.leaves):
            assert (leaf[members] == number).all()
        met = defaultdict(set)
        for number, which in tree.reached(rows, 2):
            for q in which.tolist():
                met[q] |= set(tree.leaves[number].tolist())
        away = np.abs(rows[:, None].astype(int) - rows[None]).sum(2)
        assert all(set(np.flatnonzero(away[q] <= 2).tolist()) <= met[q] for q in range(len(rows)))
