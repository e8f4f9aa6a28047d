"""The prefix trie, language identification and hard negatives, against brute force on small odd tables."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cellpub.llm import hard_negatives as hn
from cellpub.llm import language_id, prefix_trie
from cellpub.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
TURNS = "conv_id long, turn long, role string, text string, seq string, chars int, part int"


def borrowed(c):
    return zlib.crc32(str(c).encode()) % 6


def head(c):
    return c - int(math.fmod(c, 100))


def brute_trie(rows):
    own = defaultdict(list)
    for r in rows:
        if r[0] is not None:
            role, text = r[2] or "", r[3] or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]
            own[r[0]].append(((r[1] is not None, r[1] or 0), digest, (role, text)))
    convs = {}
    for c, turns in own.items():
        turns.sort()
        h = borrowed(c)
        convs[c] = tuple(t[2] for t in sorted(own.get(head(c), []))[:h]) + tuple(t[2] for t in turns[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c, seq in sorted(convs.items()):
        ends[seq].append(c)
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    children = Counter(k[:-1] for k in members if k)
    leaves, saved = Counter(), Counter()
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not children[k]
            saved[k[:d]] += (len(m) - 1) * (len(k[-1][1]) if k else 0)
    sha = lambda k: hashlib.sha256(",".join(map(str, ends[k])).encode()).hexdigest()
    return sorted((m[0], len(k), members[k[:-1]][0] if k else -1, len(m), children[k], leaves[k], saved[k], sha(k)) for k, m in members.items())


def op11(df):
    c = F.col("conv_id")
    found = prefix_trie.trie(prefix_trie.rebuilt(df, c - c % 100, (F.crc32(c.cast("string").cast("binary")) % 6).cast("int")))
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(tuple(-1 if x is None else x for x in r) for r in found.select(*names).collect())


def random_turns(seed, n, alphabet, most, hot=0):
    """Conversations of few different turns, so prefixes are shared; ``hot`` of them are the same."""
    rng, rows = random.Random(seed), []
    for _ in range(n):
        c = rng.choice([rng.randrange(-150, 400), rng.randrange(10_000)])
        for t in range(rng.randint(1, most)):
            rows.append((c, rng.choice([t, t, t, None]), rng.choice(["user", "user", None]), rng.choice(alphabet), "s", 1, 2))
    for c in range(20_000, 20_000 + hot):
        rows += [(c, t, "user", "the same", "s", 1, 2) for t in range(3)]
    return rows


@pytest.mark.parametrize(("seed", "n", "most", "hot", "parts"), [(0, 40, 4, 0, 3), (1, 60, 9, 80, 8), (2, 5, 2, 300, 13), (3, 150, 40, 10, 31), (4, 1, 1, 0, 4), (5, 80, 6, 0, 40)])
def test_trie_against_brute_force(spark, seed, n, most, hot, parts):
    rows = random_turns(seed, n, ["", "a", "é日", None, "longer text"], most, hot) + [(None, 1, "user", "nobody's", "s", 1, 2)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        assert op11(spark.createDataFrame(rows, TURNS).repartition(3)) == brute_trie(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_trie_of_odd_tables(spark):
    assert op11(spark.createDataFrame([], TURNS)) == []
    # A very long conversation and its copy, which share 120 turns; a conversation that loses all turns.
    long = [(c, t, "user", f"turn {t} " * 4000, "s", 1, 2) for c in (7, 8) for t in range(120)]
    gone = next(c for c in range(100, 200) if borrowed(c) and head(c) == 100 and c != 100)
    rows = long + [(gone, 0, "user", "only", "s", 1, 2)]
    assert op11(spark.createDataFrame(rows, TURNS)) == brute_trie(rows)


def test_components_merge_in_descending_depth():
    """Five sequences abcd, abce, abf, g, gh as items with their common prefixes as edges."""
    forest = prefix_trie.Forest()
    items = [forest.add(d, 1, i, [1] * d) for i, d in enumerate((4, 4, 3, 1, 2))]
    top = forest.merged(items, [3, 2, 0, 1])
    assert (forest.depth[top], forest.n[top], forest.children[top], forest.leaves[top]) == (0, 5, 2, 4)
    # ab and abc have three and two members of one code point a turn: a, b (2 each), c (1); g has two (1).
    assert forest.saved[top] == 2 + 2 + 1 + 1
    assert prefix_trie.common_turns(b"x" * 16 * 200 + b"y" * 16, b"x" * 16 * 200 + b"z" * 32) == 200


# -- language identification


def naive_bits(texts, text):
    """Code length of each byte of ``text`` by partial matching learnt from ``texts``, from the definition."""
    order, seen = language_id.ORDER, defaultdict(Counter)
    for t in texts:
        padded = b"\n" * order + t.encode()
        for i in range(order, len(padded)):
            for k in range(order + 1):
                seen[padded[i - k : i]][padded[i]] += 1
    padded, out = b"\n" * order + text, []
    for i in range(order, len(padded)):
        bits, gone = 0.0, set()
        for k in range(order, -1, -1):
            counts = seen.get(padded[i - k : i])
            if counts is None:
                continue
            left = {b: n for b, n in counts.items() if b not in gone}
            kinds = len(left) if len(counts) < 256 else 0
            whole = sum(left.values()) + kinds
            if padded[i] in left:
                bits += math.log2(whole / left[padded[i]])
                break
            if whole:
                bits += math.log2(whole / kinds) if kinds else math.inf
            gone = set(counts)
        else:
            bits += math.log2(256 - len(gone))
        out.append(bits)
    return out


def tree_of(texts):
    counts = Counter()
    for t in texts:
        codes = language_id.sequences(np.frombuffer(t.encode(), np.uint8), np.zeros(1, np.int64))
        for d in range(1, language_id.ORDER + 2):
            counts.update((d, int(c) & ((1 << 8 * d) - 1)) for c in codes)
    depth, code, n = (np.array(x) for x in zip(*[(d, c, k) for (d, c), k in counts.items()]))
    return depth, code, n


TEXTS = ["abracadabra", "abrakadabra, sim sala bim", "banana bandana", "aaaaaaa", "éàé ßß 日本"]


def test_code_lengths_are_those_of_the_definition():
    tree = language_id.Tree(*tree_of(TEXTS))
    for text in ("abrac", "banabra", "xyz", "日本é", "aaaaab", "\n\n\n\na"):
        data = np.frombuffer(text.encode(), np.uint8)
        found = tree.bits(language_id.sequences(data, np.zeros(1, np.int64)).astype(np.int64))
        assert np.allclose(found, naive_bits(TEXTS, text.encode()))


def test_probabilities_of_a_context_sum_to_one():
    tree = language_id.Tree(*tree_of(TEXTS))
    for context in (b"abr", b"zzz", b"zan", b"\n\n\n", b"xab", b"aaa", b"q d"):
        codes = int.from_bytes(context, "big") * 256 + np.arange(256)
        assert abs(np.exp2(-tree.bits(codes)).sum() - 1) < 1e-9


def test_contexts_that_have_seen_all_bytes_have_no_escape():
    text = "".join(chr(c) for c in range(128))
    depth, code, n = tree_of([text])
    some = np.array([c for c in range(128, 256)])
    tree = language_id.Tree(np.append(depth, [1] * 128), np.append(code, some), np.append(n, [1] * 128))
    assert abs(np.exp2(-tree.bits(np.arange(256) + (999 << 8))).sum() - 1) < 1e-9


def test_table_slots_and_slices_change_nothing(monkeypatch):
    texts = ["das ist ein Haus und", "the house is over there", "", None, "x", "the " * 3000, "ein " * 2999 + "é"]
    parts = [tree_of(["das ist ein Haus und noch eins"]), tree_of(["the house is over there and here"])]
    lang = np.array(["de"] * len(parts[0][0]) + ["en"] * len(parts[1][0]))
    columns = [np.concatenate(x) for x in zip(*parts)]
    results = []
    for cells, size in ((language_id.CELLS, language_id.SLICE), (20, 50), (0, 7)):
        monkeypatch.setattr(language_id, "CELLS", cells)
        monkeypatch.setattr(language_id, "SLICE", size)
        model = language_id.Model(lang, *columns)
        lengths = np.zeros((len(texts), 2), dtype=np.int64)
        for rows, starts, codes in language_id._slices(pa.array(texts)):
            lengths[rows] += model.lengths(codes, starts)
        results.append(lengths.tolist())
    assert results[0] == results[1] == results[2]
    units = [[np.rint(np.array(tree.bits(language_id.sequences(np.frombuffer((t or "").encode(), np.uint8), np.zeros(1, np.int64)).astype(np.int64))) * language_id.UNIT).sum() if t else 0 for tree in model.trees] for t in texts]
    assert results[0] == units


LANG_DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, letters string"


def lang_docs():
    rng, rows = random.Random(5), []
    words = {"de": "der die das und nicht ist ein Straße über".split(), "en": "the of and not with that this over".split(), "fr": "le la les être où ça n'est pas".split()}
    for i in range(240):
        lang = rng.choice(sorted(words))
        rows.append((i, " ".join(rng.choice(words[lang]) for _ in range(rng.randint(3, 30))), lang, "s", 1, "k", "l"))
    odd = [None, "", " \n", "123 !? 456", "日本", "x", "der und " * 40_000]
    rows += [(1000 + i, t, rng.choice(["de", None]), None, None, "k", "l") for i, t in enumerate(odd)]
    return rows + [rows[0], rows[0], (None, "the of and", "en", None, None, "k", "l")]


def test_languages_of_odd_documents(spark):
    docs = spark.createDataFrame(lang_docs(), LANG_DOCS).repartition(5)
    train = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1
    found = language_id.languages(docs, train).collect()
    assert len(found) == len(lang_docs())
    by_id = {r.doc_id: r for r in found}
    for i, letters in enumerate((False, False, False, False, True, True, True)):
        r = by_id[1000 + i]
        assert (r.lang_pred != "und") == letters and 0 <= r.score <= 1 and (letters or r.score == 0)
    known = {r[0]: r[2] for r in lang_docs()[:240]}
    held = [r for r in found if r.doc_id in known and zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert len(held) > 50 and sum(r.lang_pred == known[r.doc_id] for r in held) >= 0.98 * len(held)
    # Neither partitions nor the languages of held-out rows matter.
    other = docs.withColumn("lang", F.when(train, F.col("lang")).otherwise("de")).repartition(1)
    assert sorted(map(repr, language_id.languages(other, train).collect())) == sorted(map(repr, found))
    assert language_id.languages(docs.limit(0), train).count() == 0
    nothing = language_id.languages(docs.withColumn("lang", F.lit(None).cast("string")), train)
    assert {(r.lang_pred, r.score) for r in nothing.collect()} == {("und", 0.0)}


def test_rare_nodes_go_first(spark, monkeypatch):
    monkeypatch.setattr(language_id, "NODES", 400)
    docs = spark.createDataFrame(lang_docs(), LANG_DOCS)
    model = language_id.learnt(docs, F.col("lang"), "text", F.lit(True))
    assert sum(len(c) for t in model.trees for c in t.codes.values()) <= 400
    for tree in model.trees:
        for code in (0x20646572, 0x61626364, 0x0A0A0A74):
            assert abs(np.exp2(-tree.bits((code & ~0xFF) + np.arange(256))).sum() - 1) < 1e-9


def test_held_out_languages(spark):
    rows = QUERIES["op12_language_id"](spark, "/root/testdata/sf0.01").where("held_out")
    lang = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    both = rows.join(lang, "doc_id")
    assert both.count() > 300 and both.where("lang_pred <> lang").count() <= 3


# -- hard negatives

VECTORS = "vec_id long, embedding array<float>, label int, block long, at int, score string"


def brute_negatives(rows):
    valid = []
    for i, v, label, *_ in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        valid.append((i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * x) for x in v]))
    out = []
    for k, (i, label, v) in enumerate(valid):
        if i % 100:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, own == label) for n, (j, own, w) in enumerate(valid) if n != k)
        for minus, j, same in [s for s in scored if s[2]][:5]:
            inside = [s for s in scored if not s[2] and 80 * -minus <= 100 * -s[0] <= 100 * -minus][:5]
            out += [(i, j, r + 1, n, -minus, -m) for r, (m, n, _) in enumerate(inside)]
    return sorted(out)


def op13(df):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, hn.hard_negatives(df, "vec_id", "embedding", label, F.col("vec_id") % 100 == 0).select(*names).collect()))


def random_vectors(seed, n, dim, labels, grid):
    """Components on a coarse grid, so scores tie; a vector that a third of the rows have; odd rows."""
    rng = random.Random(seed)
    draw = lambda d: [rng.choice(grid) for _ in range(d)]
    common = draw(dim)
    rows = [(i, common if rng.random() < 0.33 else draw(rng.choice([dim, dim, dim - 1])), rng.randrange(labels), 1, 2, "s") for i in range(n)]
    odd = [(n + 1, None, 1), (n + 2, draw(dim), None), (n + 3, [float("nan")] * dim, 1), (n + 4, [None] + draw(dim - 1), 1), (n + 5, [float("inf")] * dim, 1), (n + 6, [], 1), (None, draw(dim), 1)]
    return rows + [(*r, 1, 2, "s") for r in odd] + [rows[0], rows[0], rows[3]]


@pytest.mark.parametrize(("seed", "n", "labels", "grid"), [(0, 700, 3, [-0.5, 0.0, 0.25, 0.5]), (1, 1100, 10, [-0.01, 0.1, 0.3]), (2, 500, 1, [0.5, 1.0]), (3, 900, 2, [-1.0, -0.9])])
def test_hard_negatives_against_brute_force(spark, monkeypatch, seed, n, labels, grid):
    rows = random_vectors(seed, n, 6, labels, grid)
    for block, scores in ((hn.BLOCK, hn.SCORES), (37, 500)):
        monkeypatch.setattr(hn, "BLOCK", block)
        monkeypatch.setattr(hn, "SCORES", scores)
        assert op13(spark.createDataFrame(rows, VECTORS).repartition(4)) == brute_negatives(rows)


def test_chunks_and_groups_change_nothing(spark, monkeypatch):
    rows = random_vectors(7, 900, 5, 4, [0.1, 0.2, -0.3, 0.7])
    monkeypatch.setattr(hn, "CHUNK", 3)
    monkeypatch.setattr(hn, "GROUP", 60)
    monkeypatch.setattr(hn, "BLOCK", 25)
    assert op13(spark.createDataFrame(rows, VECTORS).repartition(3)) == brute_negatives(rows)


def test_hard_negatives_of_odd_tables(spark):
    assert op13(spark.createDataFrame([], VECTORS)) == []
    lone = [(0, [1.0, 2.0], 1, 1, 2, "s"), (1, [1.0, 2.0], 2, 1, 2, "s")]
    assert op13(spark.createDataFrame(lone, VECTORS)) == []  # no positive
    # Large components: exact beyond 2^53, an error where a score does not fit a long.
    wide = [(100 * i, [2.0**20 + 0.25 * i, 2.0**21], 1 + i % 2, 1, 2, "s") for i in range(8)]
    assert op13(spark.createDataFrame(wide, VECTORS)) == brute_negatives(wide)
    with pytest.raises(Exception, match="do not fit a long"):
        op13(spark.createDataFrame([(100 * i, [3e30], 1, 1, 2, "s") for i in range(3)], VECTORS))
