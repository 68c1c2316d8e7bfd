"""Every dealt operator against a brute-force version, and on awkward rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from maskwright.llm import common, components, gif, mixing, pieces, pii, quality, secrets, simhash, substrings, tokencount, topk

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(t):
    return WORD.findall(t or "")


def corpus():
    """Copies, near copies, shared passages, hot groups, odd characters, nulls, repeated rows and one long text."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage, base = text(70), text(160)
    rows = []
    for i in range(120):
        t = text(rng.randint(0, 150))
        if i % 4 == 0:
            t = f"{t} {passage} {text(20)}"
        if i % 5 == 0:
            w = base.split()
            for _ in range(i % 3):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            t = " ".join(w)
        rows.append((i * 7 % 120 + 100, t, rng.choice(["en", "de", None]), rng.choice(["s0", "s0", "s1", "s2", None]), len(t)))
    rows += [(i, "same text in all of these rows", "en", "hot", 30) for i in range(40)]
    rows += [
        (900, None, None, None, None),
        (901, "", "en", "s1", 0),
        (902, " \t\n\x0b\x0c\r ", "en", "s1", 6),
        (903, "a" * 30_000, "en", "s1", 30_000),
        (904, passage * 40, "en", "s2", 1),
        (905, "word " * 3000, "en", "s2", 1),
        (906, "é😀▁ \x00 \x1f x y", "xx", "s2", 1),
        (None, passage, "en", "s0", 1),
        (None, None, None, None, None),
        (907, passage, "en", "s0", 1),
        (907, passage, "en", "s0", 1),
        (907, text(60), "en", "s0", 1),
        (9_007_199_254_740_993, "large id", "en", "s0", 1),
    ]
    return rows


ROWS = corpus()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def clash(df):
    """Extra columns under names that the operators use inside."""
    for n in ("fp", "rid", "h", "key", "d", "at", "kept", "blob", "base", "ids", "size", "target", "rep", "u", "v", "_slice"):
        df = df.withColumn(n, F.lit("x"))
    return df


def got(df, *columns):
    return sorted(map(repr, map(tuple, df.select(*columns).collect())))


# ---------------------------------------------------------------- 1 PII


def base_pii(t):
    t, out = t or "", []
    out += [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(c) for c in m[0] if c.isdigit()][::-1]
        if 13 <= len(d) <= 19 and sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(d)) % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return ",".join(f"{k}:{a}:{b}" for k, a, b in out)


def test_pii_base_spans(spark, docs):
    rng = random.Random(1)
    bits = ["a@b.c", "@", ".", "a", "-", "+1 (555) 123-4567", "4111111111111111", "4111 1111 1111 1111", "1.2.3.4", "256.1.1.1", "0001.2.3.255", " ", "é", "😀", "_", "a.b@c-d.e.f", "1", "3.4.5", "\n", "+", "%"]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randint(0, 40)))) for i in range(300)] + [(900, "1" * 9000), (901, "a@b." * 3000), (902, "a@" + "b." * 9000 + "c"), (903, "4" * 26), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").union(docs.select("doc_id", "text"))
    want = sorted(repr((i, base_pii(t))) for i, t in [*rows, *[r[:2] for r in ROWS]])
    found = pii.find_pii(clash(df))
    assert got(found.select("doc_id", pii.joined(F.col("base"), "kind").alias("b")), "doc_id", "b") == want


def test_pii_learns_from_context(spark, empty):
    rows = [(i, f"please write to account {i} mail someone{i}@example.com now") for i in range(6)]
    rows += [(10, "and mail someone@localhost today"), (11, "they mail nothing"), (12, "price someone@localhost")]
    found = {r.doc_id: r.s for r in pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", pii.joined(F.col("found"), "kind").alias("s")).collect()}
    assert found[10] == "email:9:26"
    assert found[0].startswith("email:") and found[11] == "" and found[12] == ""
    assert pii.find_pii(empty).count() == 0


def test_pii_learns_labels_and_both_sides(spark, monkeypatch):
    """Through the registered query: a label with its separator and a shape, and words on both sides, add spans."""
    rng = random.Random(2)
    noise = lambda: " ".join(rng.choice("abcdefgh") * rng.randint(2, 6) for _ in range(6))
    rows = [(i, f"{noise()} karta: 4111 1111 1111 1111 {noise()}" if i % 2 else f"{noise()} kartou: 55{i:02}5555{i:02}55 {noise()}") for i in range(8)]
    rows += [(100 + i, f"{noise()} node 10.0.{i}.7 replied") for i in range(5)] + [(110, f"{noise()} node 10.0.3.999 replied"), (111, f"{noise()} node 10.0.3.999 slept")]
    rows += [(120 + i, f"{noise()} kontakt= user{i}@example.org;") for i in range(5)] + [(130, f"{noise()} kontakt= user9@intranet;"), (131, f"{noise()} 123456789012345")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(pii, "table", lambda *_: df)
    out = {r.doc_id: r for r in pii.op1_pii(spark, "").collect()}
    at = lambda i, x: next(t for d, t in rows if d == i).index(x)
    assert out[110].spans == f"ip:{at(110, '10.0')}:{at(110, '10.0') + 10}" and out[110].n_ip == 0
    assert out[130].spans == f"email:{at(130, 'user9')}:{at(130, 'user9') + 14}" and out[130].n_email == 0
    assert out[131].spans == "" and all(out[i].spans == base_pii(t) for i, t in rows if i not in (110, 111, 130))


def test_pii_of_a_machine_made_text(spark):
    rows = [(1, "é x@y.zz 1.2.3.4 " * 60_000)]
    r = pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).select(F.size("base").alias("n"), F.element_at("base", -1).alias("last")).first()
    assert r.n == 120_000 and (r["last"].start, r["last"].end) == (17 * 60_000 - 8, 17 * 60_000 - 1)


# ---------------------------------------------------------------- 2 mixing


def test_mixing(docs, empty):
    mixed = mixing.mix(clash(docs))
    assert "x" in {r.target for r in mixed.select("target").collect()}
    rows = mixed.select("doc_id", "text", "source", "mix").collect()
    assert len(rows) == len(ROWS)
    sizes = defaultdict(int)
    for _, t, _, s, _ in ROWS:
        sizes[s] += len(words(t))
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, open_, target = sum(sizes.values()), set(order), {}
    while True:
        rest = total - sum(target[s] for s in order if s not in open_)
        share = sum(weight[s] for s in open_)
        over = [s for s in open_ if rest * weight[s] / share > 3 * sizes[s]]
        if not over:
            target |= {s: rest * weight[s] / share for s in open_}
            break
        for s in over:
            target[s] = 3 * sizes[s]
            open_.discard(s)
    taken = defaultdict(int)
    for r in rows:
        assert r.mix.size == len(words(r.text)) and r.mix.source_size == sizes[r.source]
        assert abs(r.mix.target - target[r.source]) < 1e-6 * max(1, total)
        assert 0 <= r.mix.taken <= 3 * r.mix.size and r.mix.taken == sum(p.words for p in r.mix.passes)
        assert all((p.position is None) or 0 <= p.position <= 1 for p in r.mix.passes)
        taken[r.source] += r.mix.taken
    assert all(abs(taken[s] - target[s]) <= 1 for s in order)
    positions = [r.p for r in mixing.schedule(mixing.mix(docs)).select(F.col("mix_pass.position").alias("p")).collect()]
    assert positions == sorted(positions)
    assert got(mixing.mix(docs), "doc_id", "mix.taken") == got(mixing.mix(docs.repartition(2)), "doc_id", "mix.taken")
    assert mixing.mix(empty).count() == 0


def test_mixing_without_ids(spark):
    """All doc_ids null: slices still spread, and what is taken adds up."""
    rows = [(None, "w " * (i % 7 + 1) + str(i), "en", "s1" if i % 3 else "s2", 1) for i in range(900)]
    mixed = mixing.mix(spark.createDataFrame(rows, SCHEMA), keep=["doc_id", "source"])
    assert mixed.select("mix.order_key").distinct().count() == 900
    by = {r.source: r for r in mixed.groupBy("source").agg(F.sum("mix.taken").alias("n"), F.first("mix.target").alias("t")).collect()}
    assert all(abs(r.n - r.t) <= 1 for r in by.values())


def test_mixing_counts_words_without_arrays(spark, monkeypatch):
    """No array of all words is made, and the sums of the slices, a few rows, do not go to a file for each partition."""
    made, stored = {}, mixing.stored
    monkeypatch.setattr(mixing, "stored", lambda df, name: made.setdefault(name, (df._jdf.queryExecution().toString(), df := stored(df, name)))[1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    odd = [None, "", " ", "\n \t", "a", " a", "a ", "a\x0b\x0cb\r\n c", "\x1fa\x85b \u00a0c\u2003d", "$1 \\1 \U0001f600x \U0001f600", "\x00 \x00", "e\u0301 \u0301 \ufeff", "word " * 30000, "w" * 100000]
    try:
        rows = mixing.mix(spark.createDataFrame([(i, t, "en", f"s{i % 3}", 1) for i, t in enumerate(odd)], SCHEMA), keep=["doc_id"]).select("doc_id", "mix.size").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert {r.doc_id: r.size for r in rows} == {i: len(words(t)) for i, t in enumerate(odd)}
    assert "regexp_extract_all" not in made["sizes"][0].lower()
    assert len(made["cells"][1].inputFiles()) <= 4


# ---------------------------------------------------------------- 3 token counts


@pytest.mark.parametrize("block", [16, 1000, 1 << 19])
def test_separator_scan(spark, tmp_path, block):
    rng, want = np.random.default_rng(0), []
    for k, n in enumerate([0, 1, 5, 64, 1000, 7777]):
        x = rng.integers(0, 6, n).astype("<u2")
        if k == 5:
            x[:3000] = 1
        x.tofile(tmp_path / f"f{k}.bin")
        ends, before = np.flatnonzero(x == 0), -1
        for i, p in enumerate(ends):
            want.append((f"f{k}.bin", i, int(p - before - 1), True))
            before = p
        if n and before < n - 1:
            want.append((f"f{k}.bin", len(ends), int(n - 1 - before), False))
    rows = tokencount.count_tokens(tokencount.token_files(spark, f"file://{tmp_path}"), end=0, block_tokens=block).collect()
    assert sorted((r.path.split("/")[-1], r.place, r.n_tokens, r.closed) for r in rows) == sorted(want)


def test_token_counts(spark, docs, tmp_path, monkeypatch):
    import base64

    import tiktoken

    with open(tokencount.VOCABULARY, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    coder = tiktoken.Encoding("t", pat_str=tokencount.PATTERN, mergeable_ranks=ranks, special_tokens={})
    monkeypatch.setattr(tokencount, "table", lambda *_: clash(docs))
    rows = tokencount.op3_token_counts(spark, "")
    assert got(rows, "doc_id", "n_tokens") == sorted(repr((r[0], len(coder.encode_ordinary(r[1] or "")))) for r in ROWS)


# ---------------------------------------------------------------- 4 substrings


def brute_repeats(rows):
    n, least = 50, {}
    split = [words(t) for _, t, *_ in rows]
    for (i, *_), w in zip(rows, split):
        for k in range(len(w) - n + 1):
            key = tuple(w[k : k + n])
            if i is not None:
                least[key] = min(least.get(key, i), i)
    out = []
    for (i, *_), w in zip(rows, split):
        gone = set()
        for k in range(len(w) - n + 1):
            low = least.get(tuple(w[k : k + n]))
            if low is not None and (i is None or low < i):
                gone.update(range(k, k + n))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def test_repeated_passages(spark, docs, empty):
    assert got(substrings.remove_repeats(clash(docs)), "doc_id", "n_words", "n_removed", "kept") == sorted(map(repr, brute_repeats(ROWS)))
    assert substrings.remove_repeats(empty).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_repeated_passages_at_random(spark, seed):
    rng = random.Random(seed)
    pool = [[rng.choice("pqrst") + str(rng.randrange(30)) for _ in range(rng.randint(10, 90))] for _ in range(12)]
    rows = [(rng.randrange(60), " ".join(sum((rng.choice(pool) for _ in range(rng.randint(0, 5))), []))) for _ in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got(substrings.remove_repeats(df), "doc_id", "n_words", "n_removed", "kept") == sorted(map(repr, brute_repeats(rows)))


@pytest.mark.parametrize("keep", [0x3, 0xFF])
def test_repeated_passages_when_kmer_hashes_clash(spark, docs, monkeypatch, keep):
    """Almost all k-mers collide, so that minimizers are ties and shared by different words."""
    whole = substrings.Hashed.every
    monkeypatch.setattr(substrings.Hashed, "every", lambda self, k: whole(self, k) & np.uint64(keep))
    _in_process(spark, monkeypatch)
    assert got(substrings.remove_repeats(docs), "doc_id", "n_words", "n_removed", "kept") == sorted(map(repr, brute_repeats(ROWS)))


@pytest.mark.parametrize("keep", [0x1, 0xF])
def test_repeated_passages_when_paths_clash(spark, docs, monkeypatch, keep):
    """How edges go on collides too: claims of paths fail at the source and are told apart by words."""
    whole = substrings.Hashed.ranges
    monkeypatch.setattr(substrings.Hashed, "ranges", lambda self, a, z: whole(self, a, z) & np.uint64(keep))
    _in_process(spark, monkeypatch)
    assert got(substrings.remove_repeats(docs), "doc_id", "n_words", "n_removed", "kept") == sorted(map(repr, brute_repeats(ROWS)))


def _in_process(spark, monkeypatch):
    """Run mapInArrow functions in this process, so that they see what a test has changed."""
    import pyarrow as pa
    from pyspark.sql.classic.dataframe import DataFrame

    def here(self, run, schema, *_, **__):
        rows = self.toArrow()
        made = list(run(iter(rows.combine_chunks().to_batches())))
        kind = spark.createDataFrame([], schema).schema
        table = pa.Table.from_batches(made) if made else None
        return spark.createDataFrame(table.to_pylist() if table else [], kind)

    monkeypatch.setattr(DataFrame, "mapInArrow", here)


def test_many_equal_rows(spark):
    """Repeated rows of one long text, beside a smaller document that holds it."""
    rng = random.Random(7)
    long = " ".join(f"w{rng.randrange(10**6)}" for _ in range(1500))
    rows = [(1, long)] + [(2, long)] * 600 + [(None, long)] * 300 + [(3, None)] * 3
    out = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).groupBy("doc_id", "n_words", "n_removed").count().collect()
    assert sorted(map(repr, map(tuple, out))) == sorted(map(repr, [(1, 1500, 0, 1), (2, 1500, 1500, 600), (None, 1500, 1500, 300), (3, 0, 0, 3)]))


# ---------------------------------------------------------------- 5 pieces


@pytest.fixture(scope="module")
def coder():
    return pieces.Pieces(pieces.read_model(pieces.MODEL))


def all_segmentations(coder, s):
    if not s:
        return [(0, ())]
    out = []
    for end in range(1, min(len(s), coder.longest) + 1):
        for start, score, ids in coder._edges(s, end):
            if start == 0:
                out += [(score + a, ids + b) for a, b in all_segmentations(coder, s[end:])]
    return out


def test_n_best_is_exact(coder):
    rng = random.Random(0)
    for _ in range(60):
        s = "".join(rng.choice(["the", "in", " ", "é", "▁", "\n", "a", "ing", "x", "😀", "  "]) for _ in range(rng.randint(0, 5)))
        every = sorted(all_segmentations(coder, " " + s), key=lambda x: -x[0])
        ids, best = coder.encode([s], 4)[0]
        assert [round(b * pieces.UNIT) for b, _ in best] == [b for b, _ in every[:4]]
        assert coder.decode(ids) == s


def score_of(coder, ids):
    score = {i: coder.score[p] for p, i in coder.ids.items()} | {i: coder.byte_score for i in coder.bytes.values()}
    return sum(score[i] for i in ids)


def test_n_best_segmentations(coder):
    """Each of the n best is another segmentation of the text, has its score, and none better is left out."""
    rng = random.Random(5)
    for n in (1, 2, 3, 7):
        for _ in range(30):
            s = "".join(rng.choice(["the", "in", " ", "é", "▁", "\n", "a", "ing", "x", "😀", "  "]) for _ in range(rng.randint(0, 5)))
            every = {ids: score for score, ids in all_segmentations(coder, " " + s)}
            best = [(round(b * pieces.UNIT), tuple(np.frombuffer(i, dtype="<i4").tolist())) for b, i in coder.n_best([s], n)[0]]
            assert [b for b, _ in best] == sorted(every.values(), reverse=True)[:n]
            assert len({i for _, i in best}) == len(best) and all(every[i] == b for b, i in best)


def test_n_best_of_long_texts(coder):
    s = "An ordinary sentence, unbelievably 😀 long. " * 40 + "x" * 60
    best = coder.n_best([s], 5)[0]
    assert len({i for _, i in best}) == 5 and best[0][1] == coder.encode([s], 5)[0][0]
    for b, i in best:
        assert coder.decode(i) == s and score_of(coder, np.frombuffer(i, dtype="<i4").tolist()) == round(b * pieces.UNIT)


def test_chunks_in_use_outlast_the_others(monkeypatch):
    monkeypatch.setattr(pieces, "KEPT", 40)
    model = pieces.read_model(pieces.MODEL)
    coder = pieces.Pieces(model)
    for k in range(12):
        texts = [f"often used {k}a{j} {k * j}b" for j in range(8)]
        assert coder.n_best(texts) == pieces.Pieces(model).n_best(texts)
        assert len(coder._place) == len(coder._encoded) <= 40
    learnt = []
    monkeypatch.setattr(coder, "_learn", lambda chunks, learn=coder._learn: learnt.extend(chunks) or learn(chunks))
    coder.n_best([" ".join(f"x{j}y" for j in range(30)), "often used"])
    assert " x0y" in learnt and not {" often", " used"} & {*learnt}


def test_spelled_ids(coder):
    rng = np.random.default_rng(8)
    for _ in range(300):
        lists = [rng.integers(5, 8, rng.integers(1, 9)).astype("<i4") for _ in range(3)]
        assert coder.spell([x.tobytes() for x in lists]) == [" ".join(map(str, x)).encode() for x in lists]


def test_n_best_among_equals():
    model = [("", 0.0, b) for b in range(256)] + [(p, -2.0 * len(p), -1) for p in (" ", "a", "aa", "aaa", " a", " aa")]
    own = pieces.Pieces(model)
    for n in range(1, 9):
        best = own.n_best(["aaaa"], n)[0]
        assert len({i for _, i in best}) == n and {b for b, _ in best} == {-10.0} and all(own.decode(i) == "aaaa" for _, i in best)
        assert best[0][1] == own.n_best(["aaaa"], 1)[0][0][1]


def test_n_best_columns(spark, docs, coder):
    rows = pieces.segmented(docs).collect()
    for r in rows:
        assert r.n_best[0]["ids"] == r.ids and all(len(b["ids"]) == b["pieces"] for b in r.n_best)
        assert all(coder.decode(np.array(b["ids"], dtype="<i4").tobytes()) == r.decoded for b in r.n_best)
    import hashlib

    want = sorted(repr([hashlib.sha256(" ".join(map(str, b["ids"])).encode()).hexdigest() for b in r.n_best]) for r in rows)
    assert sorted(repr(r.n_best_sha256) for r in pieces.digests(pieces.segmented(docs)).collect()) == want


def test_pieces_come_back(spark, docs, coder, empty):
    rows = pieces.segmented(clash(docs)).collect()
    assert sorted(repr((r.doc_id, r.decoded)) for r in rows) == sorted(repr((r[0], r[1] or "")) for r in ROWS)
    assert all(coder.decode(np.array(r.ids, dtype="<i4").tobytes()) == r.decoded for r in rows)
    assert all(list(r.n_best) == sorted(r.n_best, key=lambda b: -b.score) for r in rows)
    assert pieces.segmented(empty).count() == 0 and pieces.digested(empty).count() == 0
    want, found = pieces.digests(pieces.segmented(docs)), pieces.digested(docs)
    assert found.dtypes == want.dtypes and sorted(map(repr, found.collect())) == sorted(map(repr, want.collect()))


def test_pieces_of_a_unigram_like_model():
    model = [("", 0.0, -1)] + [("", 0.0, b) for b in range(256)] + [(p, s, -1) for p, s in ((" a", -1.0), ("a", -2.0), ("b", -2.5), ("ab", -3.0), (" ab", -4.5), (" ", -1.5))]
    own = pieces.Pieces(model)
    ids, best = own.encode(["ab"], 3)[0]
    assert own.decode(ids) == "ab" and best[0][0] == -3.5 and best[1][0] == -4.5


# ---------------------------------------------------------------- 6 secrets


def base_secrets(t):
    t, out = t or "", []
    for m in re.finditer(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t, re.ASCII):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, f"assign:{m.start()}:{m.end()}"))
    out += [(m.start(), 1, f"access:{m.start()}:{m.end()}") for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    out += [(m.start(), 2, f"hex:{m.start()}:{m.end()}") for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    return ",".join(x for *_, x in sorted(out))


def test_secrets(spark, docs, empty, tmp_path):
    rng = random.Random(3)
    bits = ["token", " = ", '"', "'", "abcdef123", "AKIA", "AKIA" + "A1" * 8, "f" * 30, "0a" * 12, "password:", "API_KEY=", "x", " ", "é", "ghp_" + "a" * 36, "\n", "secret", ":", "12345"]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randint(0, 25)))) for i in range(300)] + [(800, "f" * 20_000), (801, "AKIA" * 3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").union(docs.select("doc_id", "text"))
    base = F.filter("found", lambda s: s["kind"].isin(*secrets.BASE))
    out = secrets.find_secrets(clash(df)).select("doc_id", secrets.joined(base, "start").alias("b"))
    assert got(out, "doc_id", "b") == sorted(repr((i, base_secrets(t))) for i, t in [*rows, *[r[:2] for r in ROWS]])
    assert secrets.find_secrets(empty).count() == 0


def test_ledger_scans_only_what_is_new(spark, tmp_path):
    path = f"file://{tmp_path}/ledger"
    df = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    first = {"v1": secrets.RULES["base-1"]}
    secrets.scan(df([(1, "token=abcdef1"), (2, "token=abcdef1"), (3, "clean")]), path, first)
    assert spark.read.parquet(path).count() == 2
    secrets.scan(df([(1, "token=abcdef1"), (4, "xoxb-1234567890")]), path, first)
    assert spark.read.parquet(path).count() == 3
    both = first | {"v2": secrets.RULES["vendor-1"]}
    found = secrets.scan(df([(1, "token=abcdef1"), (4, "xoxb-1234567890")]), path, both)
    assert spark.read.parquet(path).groupBy("version").count().orderBy("version").collect() == [("v1", 3), ("v2", 2)]
    assert found.count() == 2
    secrets.scan(df([(5, "clean")]), path, first)
    assert spark.read.parquet(path).count() == 5
    # a run that overlapped has appended the same pairs again: no finding doubles
    again = spark.read.parquet(path).withColumn("prefix", F.col("prefix").cast("string")).collect()
    spark.createDataFrame(again, "blob string, version string, found " + secrets.FOUND + ", prefix string").write.partitionBy("prefix").mode("append").parquet(path)
    assert secrets.scan(df([(1, "token=abcdef1")]), path, both).first().found == [(0, 13, 0, "assign")]
    assert spark.read.parquet(path).count() == 10


def test_findings_of_every_version(spark, tmp_path):
    rows = [("a", 1, "clean"), ("a", 2, "token=abcdef1"), ("a", 3, "token=abcdef1 more"), ("b", 1, "token=abcdef1"), ("b", 2, None), (None, 1, "token=abcdef1"), ("c", 1, "x" * 100_000)]
    history = spark.createDataFrame(rows, "path string, version int, text string").withColumn("found", F.lit(1))
    out = secrets.findings(history, f"file://{tmp_path}/ledger")
    assert sorted(map(repr, map(tuple, out.collect()))) == sorted(map(repr, [("a", 2, "assign", 0, 13, 2), ("a", 3, "assign", 0, 13, 2), ("b", 1, "assign", 0, 13, 1), (None, 1, "assign", 0, 13, 1)]))


def test_op6_counts_every_document(spark, docs, monkeypatch):
    monkeypatch.setattr(secrets, "table", lambda *_: clash(docs))
    rows = secrets.op6_secret_scans(spark, "")
    assert got(rows, "doc_id", "base_sha256") == sorted(repr((r[0], hashlib.sha256(base_secrets(r[1]).encode()).hexdigest())) for r in ROWS)


def test_redaction(spark):
    rows = secrets.find_secrets(spark.createDataFrame([(1, 'é token = "abcdef1" and ' + "f" * 30), (2, "none"), (3, None)], "doc_id long, text string"))
    out = {r.doc_id: r.t for r in rows.select("doc_id", secrets.redact(F.col("text"), F.col("found")).alias("t")).collect()}
    assert out == {1: 'é [SECRET]" and [SECRET]', 2: "none", 3: None}


def _plans(spark) -> dict[int, str]:
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    ran = spark._jsparkSession.sharedState().statusStore().executionsList()
    return {ran.apply(i).executionId(): ran.apply(i).physicalPlanDescription() for i in range(ran.size())}


def test_findings_that_pack_well_are_not_broadcast(spark, tmp_path):
    # spans at the same places in every text take next to nothing in a file, and 64 bytes each in the driver
    rows = [(i, " ".join(hashlib.md5(f"{i} {k}".encode()).hexdigest()[:24] for k in range(30))) for i in range(300)]
    df, key, ledger = spark.createDataFrame(rows, "doc_id long, text string"), "spark.sql.autoBroadcastJoinThreshold", f"file://{tmp_path}/ledger"
    before, was = spark.conf.get(key), _plans(spark)
    spark.conf.set(key, "200k")
    try:
        secrets.scan(df, ledger, {"base-1": secrets.RULES["base-1"]})
        out = secrets.find_secrets(df, ledger).select("doc_id", secrets.redact(F.col("text"), F.col("found")).alias("t")).collect()
    finally:
        spark.conf.set(key, before)
    assert {tuple(r) for r in out} == {(i, " ".join(["[SECRET]"] * 30)) for i in range(300)}
    plans = [v for k, v in _plans(spark).items() if k not in was]
    assert any("SortMergeJoin" in x for x in plans) and not any("Broadcast" in x for x in plans)


# ---------------------------------------------------------------- 7 GIF


def lzw_encode(size, data, deferred=False):
    clear, end = 1 << size, (1 << size) + 1
    fresh = lambda: ({bytes((i,)): i for i in range(clear)}, end + 1, size + 1)
    table, n, w = fresh()
    codes, run = [(clear, w)], b""
    for x in data:
        longer = run + bytes((x,))
        if longer in table:
            run = longer
            continue
        codes.append((table[run], w))
        if n < 4096:
            table[longer] = n
            n += 1
            if n - 1 == 1 << w and w < 12:
                w += 1
        elif not deferred:
            codes.append((clear, w))
            table, n, w = fresh()
        run = bytes((x,))
    if run:
        codes.append((table[run], w))
        if n == 1 << w and w < 12:
            w += 1
    codes.append((end, w))
    value = at = 0
    for c, width in codes:
        value |= c << at
        at += width
    return value.to_bytes(-(-at // 8), "little")


@pytest.mark.parametrize("size,data", [(8, b"abcabcabcab" * 900), (8, bytes(range(256)) * 80), (2, bytes(i * i % 4 for i in range(20_000))), (8, b"a" * 9000), (4, b""), (8, bytes(random.Random(1).randrange(256) for _ in range(30_000)))])
def test_lzw(size, data):
    assert bytes(gif.lzw_decode(size, lzw_encode(size, data), len(data))) == data


@pytest.mark.parametrize("size,data", [(8, random.Random(2).randbytes(30_000)), (2, bytes(x & 3 for x in random.Random(3).randbytes(120_000))), (8, b"abcab" * 2000 + random.Random(4).randbytes(20_000))])
def test_lzw_deferred_clear(size, data):
    stream = lzw_encode(size, data, deferred=True)
    assert len(stream) * 8 > 3 * 4096 * 12
    assert bytes(gif.lzw_decode(size, stream, len(data))) == data
    later = lzw_encode(size, data, deferred=True) + lzw_encode(size, data[::-1])  # an end code ends it, whatever follows
    assert bytes(gif.lzw_decode(size, later, 2 * len(data))) == data
    assert data.startswith(bytes(gif.lzw_decode(size, stream[: len(stream) // 2], len(data)))[:-1])


def test_lzw_clear_after_a_deferred_run():
    """A full table used for long, then a clear code, then a fresh table."""
    rng = random.Random(4)
    first, last = [rng.randrange(256) for _ in range(20_000)], [rng.randrange(256) for _ in range(300)]
    parts, n = [], 0
    for c in [256, *first, 256, *last, 257]:
        w = min(12, max(9, (258 + max(n - 1, 0)).bit_length()))
        parts.append(f"{c:0{w}b}"[::-1])
        n = 0 if c == 256 else n + 1
    s = "".join(parts)
    stream = bytes(int(s[k : k + 8][::-1], 2) for k in range(0, len(s), 8))
    assert bytes(gif.lzw_decode(8, stream, 30_000)) == bytes(first + last)


def frame_bytes(x, y, w, h, data, disposal=0, clear=None, delay=0, palette=None, interlaced=False, size=2):
    import struct

    head = b"\x21\xf9\x04" + struct.pack("<BHB", disposal << 2 | (clear is not None), delay, clear or 0) + b"\0"
    flags = (0x81 if palette else 0) | (0x40 if interlaced else 0)
    return head + b"\x2c" + struct.pack("<HHHHB", x, y, w, h, flags) + (palette or b"") + bytes((size,)) + gif._blocks(lzw_encode(size, data))


def test_frames_disposal_and_transparency(spark):
    palette = bytes([0, 0, 0, 255, 0, 0, 0, 255, 0, 0, 0, 255])
    import struct

    b = b"GIF89a" + struct.pack("<HHBBB", 2, 2, 0x81, 0, 0) + palette
    b += frame_bytes(0, 0, 2, 2, bytes([1, 1, 1, 1]), delay=5)
    b += frame_bytes(0, 0, 1, 2, bytes([2, 0]), clear=0, disposal=3, delay=7)
    b += frame_bytes(1, 1, 1, 1, bytes([3]), disposal=2, delay=1)
    b += frame_bytes(0, 0, 1, 1, bytes([2]))
    f = [(x, x.canvas.copy()) for x in gif.frames(b + b"\x3b")]
    colour = lambda k, y, x: tuple(int(v) for v in f[k][1][y, x : x + 1].view(np.uint8))
    red, green, blue, none = (255, 0, 0, 255), (0, 255, 0, 255), (0, 0, 255, 255), (0, 0, 0, 0)
    assert [x.start for x, _ in f] == [0, 5, 12, 13]
    assert colour(1, 0, 0) == green and colour(1, 1, 0) == red
    assert colour(2, 0, 0) == red and colour(2, 1, 1) == blue
    assert colour(3, 1, 1) == none and colour(3, 0, 0) == green
    tall = b"GIF89a" + struct.pack("<HHBBB", 1, 8, 0x81, 0, 0) + palette + frame_bytes(0, 0, 1, 8, bytes([0, 1, 2, 2, 3, 3, 3, 3]), interlaced=True) + b"\x3b"
    assert next(gif.frames(tall)).indices[:, 0].tolist() == [0, 3, 2, 3, 1, 3, 2, 3]
    rows = gif.gif_frames(spark.createDataFrame([(1, b), (2, b"no"), (3, None)], "media_id long, media binary")).collect()
    assert [(r.key, r.frame, r.start_cs) for r in rows] == [(1, 0, 0), (1, 1, 5), (1, 2, 12), (1, 3, 13)]
    assert rows[0].red[7] == 4 and rows[0].green[0] == 4


def test_hostile_files(spark):
    """Claims of sizes are refused, broken files give what came before, and nothing raises."""
    import struct

    head = lambda w, h: b"GIF89a" + struct.pack("<HHBBB", w, h, 0x81, 0, 0) + bytes(12)
    good = frame_bytes(0, 0, 2, 2, bytes([1, 1, 1, 1]))
    files = [
        head(2, 2) + good + frame_bytes(0, 0, 1, 1, bytes([1]))[:-3] + bytes((63,)),  # breaks off
        head(1, 1) + b"\x2c" + struct.pack("<HHHHB", 0, 0, 1, 1, 0) + bytes((63, 0)),  # root size 63
        head(65535, 65535) + b"\x2c" + struct.pack("<HHHHB", 0, 0, 65535, 65535, 0) + bytes((2, 0)),  # a huge picture
        head(65535, 65535) + good + b"\x3b",  # a huge screen, but a small picture
        head(65535, 65535) + good + frame_bytes(65534, 65534, 1, 1, bytes([1])) + b"\x3b",  # small pictures far apart
        b"GIF89a", b"GIF", b"", head(2, 2)[:15], head(2, 2) + b"\x21\xf9\xff", head(2, 2) + b"\x2c\x00",
        b"GIF89a" + struct.pack("<HHBBB", 2, 2, 0, 0, 0) + good,  # no palette
    ]
    rng = random.Random(6)
    whole = head(4, 4) + good + frame_bytes(1, 1, 2, 2, bytes([0, 1, 2, 3]), clear=1, disposal=3)
    files += [bytes(rng.randrange(256) if rng.random() < 0.05 else x for x in whole[: rng.randrange(len(whole))]) for _ in range(200)]
    rows = gif.gif_frames(spark.createDataFrame(list(enumerate(files)), "media_id long, media binary")).collect()
    by = {k: [r for r in rows if r.key == k] for k in range(12)}
    assert len(by[0]) >= 1 and by[0][0].width == 2 and not by[1] and not by[2] and not by[4] and not any(by[k] for k in range(5, 11))
    assert [(r.width, r.height) for r in by[3]] == [(2, 2)] and [(r.width, len(r.pixels)) for r in by[11]] == [(2, 16)]


@pytest.mark.parametrize("data", [b"", b"a", b"ab" * 20_000, bytes(range(256)) * 60, random.Random(8).randbytes(50_000), "příliš žluťoučký kůň ".encode() * 3000])
def test_lzw_written(data):
    stream = gif.lzw_encode(data)
    assert bytes(gif.lzw_decode(8, stream, len(data))) == data
    assert len(data) < 1000 or len(set(data)) > 200 or len(stream) < len(data)


def test_media_round_trip(docs, empty):
    rows = gif.read_back(gif.text_media(clash(docs))).collect()
    want = []
    for i, t, *_ in ROWS:
        raw = (t or "").encode()
        full = raw.ljust(max(1, -(-len(raw) // 192)) * 192)
        want.append(repr((i, len(raw), len(full), hashlib.sha256(full).hexdigest(), zlib.crc32(full[-16:]))))
    assert sorted(repr((r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32)) for r in rows) == sorted(want)
    assert gif.read_back(gif.text_media(empty)).count() == 0


# ---------------------------------------------------------------- 8 top-k


def test_top_k(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(600)]
    rows += [(i, [0.5] * 8) for i in range(1000, 1040)] + [(2000, None), (2100, [float("nan")] * 8), (2200, [None] * 8), (2300, []), (2400, [1e9] * 8), (None, [1.0] * 8), (2500, [0.25] * 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("x")).repartition(3)
    q = topk.quantised(df)
    out = topk.top_k(q, q.filter(F.col("vec_id") % 100 == 0))
    own = {i: [int(np.floor(1024 * x)) for x in v] for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)}
    want = []
    for i in own:
        if i % 100 == 0:
            best = sorted((-sum(a * b for a, b in zip(own[i], v)), j) for j, v in own.items() if j != i)[:10]
            want += [(i, k + 1, j, -s) for k, (s, j) in enumerate(best)]
    assert sorted(map(tuple, out.collect())) == sorted(want)
    assert topk.top_k(q.limit(0), q.limit(0)).count() == 0
    few = topk.quantised(spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<double>"))
    assert [tuple(r) for r in topk.top_k(few, few.filter("vec_id = 0")).collect()] == [(0, 1, 1, 1024 * 2048)]


def test_top_k_in_blocks(spark, monkeypatch):
    rng = np.random.default_rng(4)
    df = topk.quantised(spark.createDataFrame([(i, [float(x) for x in rng.normal(size=6)]) for i in range(300)], "vec_id long, embedding array<double>"))
    whole = sorted(map(tuple, topk.top_k(df, df.filter("vec_id % 20 = 0")).collect()))
    monkeypatch.setattr(topk, "BLOCK_BYTES", 300)
    assert sorted(map(tuple, topk.top_k(df, df.filter("vec_id % 20 = 0")).collect())) == whole


def test_top_k_beyond_the_exact_range_of_doubles(spark):
    """Scores above 2^53 that tie at the cutoff, or differ by one, keep their order."""
    big = [(0, [2.0**20, 1.0]), (1, [2.0**40, 200.0]), (2, [2.0**40, 200.0]), (3, [2.0**40, 199.0]), (4, [2.0**40, 201.0]), (5, [1.0, 1.0])]
    q = topk.quantised(spark.createDataFrame(big, "vec_id long, embedding array<double>").repartition(2), 1)
    out = [tuple(r) for r in topk.top_k(q, q.filter("vec_id = 0"), 3).orderBy("rank").collect()]
    assert out == [(0, 1, 4, 2**60 + 201), (0, 2, 1, 2**60 + 200), (0, 3, 2, 2**60 + 200)]


# ---------------------------------------------------------------- 9 classifier


def labelled(spark, n=400):
    rng = random.Random(9)
    w = ["alpha", "beta", "gamma", "delta", "omega", "sigma"]
    rows, labels = [], []
    for i in range(n):
        good, toxic = rng.random() > 0.3, rng.random() > 0.7
        t = [rng.choice(w) for _ in range(rng.randint(5, 60))]
        if not good:
            t = [x + "%%%" for x in t]
        if toxic:
            t[rng.randrange(len(t))] = rng.choice(["vile", "nasty"])
        rows.append((i, " ".join(t), "en" if good else "xx", f"s{i % 3}", 1))
        if i % 2:
            labels.append((i, int(good), int(toxic)))
    truth = {i: r for i, r in enumerate(rows)}
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), truth


def test_classifier_on_held_out_rows(spark, docs, empty):
    df, labels, truth = labelled(spark)
    models = quality.fit(clash(df), labels)
    rows = {r.doc_id: r for r in quality.scored(clash(df), models).collect()}
    held = [i for i in truth if i % 2 == 0]
    assert sum((rows[i].p_quality >= 0.5) == ("%" not in truth[i][1]) for i in held) > 0.97 * len(held)
    assert sum((rows[i].p_toxic >= 0.5) == bool(re.search("vile|nasty", truth[i][1])) for i in held) > 0.95 * len(held)
    assert len(quality.scored(docs, models).collect()) == len(ROWS)
    assert quality.scored(empty, models).count() == 0


def test_classifier_learns_words_of_unlabelled_documents(spark):
    """Metadata tells the class, so words that no labelled document has must come from the unlabelled ones, all of them."""
    rng = random.Random(8)
    say = lambda own: " ".join(rng.choice(own) if rng.random() < 0.3 else f"word{rng.randrange(400)}" for _ in range(40))
    old, new = ["vile", "foul"], ["wretched", "beastly", "rancid"]
    rows = [(i, say(old if i % 3 == 0 else ["fine"]), "en", "bad" if i % 3 == 0 else "good", 200) for i in range(600)]
    rows += [(i, say(old + new if i % 3 == 0 else ["fine"]), "en", "bad" if i % 3 == 0 else "good", 200) for i in range(1000, 10_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    labels = spark.createDataFrame([(i, int(i % 3 != 0), int(i % 3 == 0)) for i in range(600)], "doc_id long, quality int, toxic int")
    model = quality.fit(docs, labels)["toxic"]
    buckets = quality.text_view(" ".join(new))[0]
    assert set(buckets.tolist()) <= set(model.chosen.tolist())
    assert (model.flat()["words"][buckets] > 0).all()
    gifts = quality._gifts(quality._pool(quality.features(docs.filter("doc_id >= 1000"))), {"toxic": model})["toxic"]
    assert gifts.rows.tolist() == [6000, 3000]  # every document, not a pool


def test_features_come_back(spark, docs):
    made = quality.features(clash(docs)).toArrow().combine_chunks()
    words, row, dense, meta = quality._unpacked(made.to_batches()[0])
    want = {r[0]: quality.text_view(r[1])[0].tolist() for r in ROWS if r[0] not in (None, 907)}
    for k, i in enumerate(made["doc_id"].to_pylist()):
        assert i not in want or words[row == k].tolist() == want[i]
    models = {"quality": 0.7, "toxic": quality.CoTrained(quality._arrays(made), np.arange(made.num_rows) % 2)}
    models["toxic"].join_views()
    a = got(quality.scored_features(quality.features(docs), models).select("doc_id", F.round("p_toxic", 9).alias("p"), "keep"), "doc_id", "p", "keep")
    assert a == got(quality.scored(docs, models).select("doc_id", F.round("p_toxic", 9).alias("p"), "keep"), "doc_id", "p", "keep")


def test_classifier_without_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.fit(docs, none) == {"quality": 1.0, "toxic": 0.0}
    one = spark.createDataFrame([(107, 1, 0), (114, 1, 0), (None, 0, 1), (121, None, 0)], "doc_id long, quality int, toxic int")
    assert quality.fit(docs, one) == {"quality": 1.0, "toxic": 0.0}
    assert quality.scored(docs, quality.fit(docs, one)).filter("keep").count() == len(ROWS)


def test_classifier_with_few_labels_nulls_and_repeated_documents(spark):
    """A model from four labels; a null leaves out one target only; a doc_id on many rows counts once."""
    df, _, _ = labelled(spark, 60)
    rows = [(1, 1, None), (3, 0, None), (5, None, 1), (7, None, 0), (7, None, 0)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    many = df.union(df.filter("doc_id = 1").withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(500)))).drop("n"))
    models = quality.fit(many, labels)
    assert all(isinstance(m, quality.CoTrained) and len(m.y) == 2 for m in models.values())
    assert quality.scored(many, models).filter("p_quality between 0 and 1 and p_toxic between 0 and 1").count() == many.count()


# ---------------------------------------------------------------- 10 SimHash


def brute_components(rows):
    ids, fps = [r[0] for r in rows], np.array([simhash.fingerprint(r[1]) for r in rows], dtype=np.uint64)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4
    order = [2**63 - 1 if i is None else i for i in ids]
    label = np.array(order)
    while True:
        low = np.array([label[r].min() for r in near])
        if (low == label).all():
            return [(i, int(f), None if c == 2**63 - 1 else int(c)) for i, f, c in zip(ids, fps, label)]
        label = low


def brute_classes(rows):
    """Number of each row's group of near copies."""
    fps = np.array([simhash.fingerprint(r[1]) for r in rows], dtype=np.uint64)
    near, label = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4, np.arange(len(rows))
    while True:
        low = np.array([label[r].min() for r in near])
        if (low == label).all():
            return label.tolist()
        label = low


def test_rows_without_id_and_clashing_ids(spark, tmp_path):
    """Nameless rows of different groups stay apart, large ids keep their own, and of one doc_id both texts stay."""
    import corpus_pipeline as p

    word = lambda i: " ".join(f"{i}w{k}" for k in range(30))
    rows = [(None, word(i), "en", "s", 1) for i in range(40)] + [(2**63 - 2, word(50), "en", "s", 1), (2**63 - 2, word(51), "en", "s", 1), (7, word(52), "en", "s", 1), (7, word(53), "en", "s", 1), (7, word(53), "en", "s", 1)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    out = simhash.near_duplicates(docs).collect()
    assert sorted(repr((r.doc_id, r.component_id)) for r in out) == sorted(repr((r[0], r[0])) for r in rows)
    assert got(p.deduplicate(spark, docs, str(tmp_path)), *p.COLUMNS) == sorted(map(repr, set(rows)))


def test_fingerprint_by_hand():
    import xxhash

    assert simhash.fingerprint(None) == simhash.fingerprint(" \n") == 0
    assert simhash.fingerprint("A b") == xxhash.xxh64_intdigest(b"a b", 42)
    t = "One two three four five six É"
    w = "one two three four five six É".encode().split()
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 4]), 42) for i in range(len(w) - 3)]
    assert simhash.fingerprint(t) == sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_near_duplicates(docs, empty):
    out = simhash.near_duplicates(clash(docs)).collect()
    assert sorted(repr((r.doc_id, r.fp % 2**64, r.component_id)) for r in out) == sorted(map(repr, brute_components(ROWS)))
    assert simhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("part", [3, 384])
def test_links_span_every_component(spark, part):
    rng = np.random.default_rng(part)
    centre = rng.integers(0, 2**63, 6, dtype=np.uint64)
    fps = set()
    for c in centre:
        for _ in range(60):
            x = c
            for b in rng.integers(0, 64, rng.integers(0, 7)):
                x ^= np.uint64(1) << np.uint64(b)
            fps.add(int(x))
    fps = sorted(fps)
    df = spark.createDataFrame([(f - 2**64 if f >= 2**63 else f, i) for i, f in enumerate(fps)], "fp long, rep long")
    a = np.array(fps, dtype=np.uint64)
    near = np.bitwise_count(a[:, None] ^ a[None, :]) <= 4
    label = np.arange(len(a))
    while True:
        low = np.array([label[r].min() for r in near])
        if (low == label).all():
            break
        label = low
    found = {r.node: r.component for r in components.components(simhash.links(df, part)).collect()}
    assert [found.get(i, i) for i in range(len(a))] == label.tolist()


def test_every_close_pair_is_chained():
    rng = np.random.default_rng(1)
    x = np.zeros(4000, dtype=np.uint64)
    for _ in range(4):
        x |= np.uint64(1) << rng.integers(0, 64, 4000).astype(np.uint64)
    assert simhash.chained(x).all()


def test_links_broadcast_no_keys(spark):
    # a small file of fingerprints stands for 45 times as many keys, which must not be sent to the driver
    fps = np.random.default_rng(3).integers(-(2**63), 2**63, 1000).tolist()
    distinct = common.stored(spark.createDataFrame([(x, x) for x in fps], "fp long, rep long"), "distinct")
    plan = simhash.links(distinct)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_components_of_a_long_path(spark):
    n = 200
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(5, 5), (1000, 1001), (1001, 1000), (None, 3)], "u long, v long")
    found = {r.node: r.component for r in components.components(edges).collect()}
    assert found == {**{i: 0 for i in range(1, n + 1)}, 1001: 1000}


# ---------------------------------------------------------------- pipeline


def test_workers_forget_what_other_operators_learnt(spark, monkeypatch):
    """Python workers outlive tasks; the words and chunks of one operator do not stay beside those of the next."""
    df = spark.createDataFrame([(i, f"alpha w{i} beta " * 20, "en", "s1", 30) for i in range(200)], SCHEMA).repartition(8).cache()

    def held(batches):
        import pyarrow as pa

        from maskwright.llm import pieces, quality, substrings

        for b in batches:
            two = sum(len(x) > 0 for x in (quality._seen, substrings._hashes, pieces._coder)) > 1
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([two] * b.num_rows)], names=["doc_id", "held"])

    for make in (quality.features, pieces.digested, substrings.remove_repeats, quality.features, pieces.digested):
        make(df).collect()
        assert not any(r.held for r in df.mapInArrow(held, "doc_id long, held boolean").collect())
    monkeypatch.setattr(common, "_learnt", {})
    learnt = {"a": [1], "b": [2]}
    for k, v in learnt.items():
        common.begins(k, v.clear)
        common.begins(k, v.clear)
    assert learnt == {"a": [], "b": [2]}
    common.begins("c")
    assert learnt["b"] == [] and common._learnt == {}


def test_small_tables_go_to_few_files(spark, monkeypatch):
    """Many partitions of a shuffle are no reason for as many files of a few numbers each."""
    made, stored = defaultdict(list), common.stored
    keep = lambda df, name: made[name].append(len((df := stored(df, name)).inputFiles())) or df
    for module in (components, simhash):
        monkeypatch.setattr(module, "stored", keep)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    try:
        rows = [(i, f"alpha beta gamma delta w{i // 2}", "en", "s1", 30) for i in range(400)]
        out = simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
        narrow = made.pop("distinct") + made.pop("classes")
        made.clear()
        chain = components.components(spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, i) for i in range(1001, 1500)], "u long, v long")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sorted(r.doc_id for r in out) == list(range(400)) and all(r.component_id <= r.doc_id - r.doc_id % 2 for r in out)
    assert {r.node: r.component for r in chain} == {i: 0 for i in range(1, 301)} | {i: 1000 for i in range(1001, 1500)}
    assert max(narrow + made["least"] + made["edges"][1:]) <= 8  # how many edges come is not known before the first table


def test_deduplicate_broadcasts_no_keys(spark, monkeypatch):
    import corpus_pipeline as p

    made, links = [], simhash.links
    monkeypatch.setattr(simhash, "links", lambda *a: made.append(links(*a)) or made[0])
    rows = [(i, f"alpha beta gamma delta w{i // 2}", "en", "s1", 30) for i in range(400)]
    assert p.deduplicate(spark, spark.createDataFrame(rows, SCHEMA), "").count() == 200
    assert len(made) == 1 and "Broadcast" not in made[0]._jdf.queryExecution().executedPlan().toString()


def test_pipeline_stage_by_stage(spark, tmp_path, coder):
    import corpus_pipeline as p

    df, labels, _ = labelled(spark, 160)
    secret = [(500 + i, f"alpha beta gamma {i} delta omega token = abcdef{i}xyz sigma", "en", "s9", 1) for i in range(8)]
    rows = df.collect() + secret + [(700, None, None, None, None), (None, None, None, None, None), (None, "alpha", None, "s1", None), (701, "", "en", None, 0), (702, "alpha beta " * 4000, "en", "s1", 2), (500, secret[0][1], "en", "s9", 1)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    now = spark.read.parquet(f"{tmp_path}/documents.parquet").withColumn("own", F.lit("x"))
    models = quality.fit(now, labels)
    keep = sorted(repr(tuple(r)[:5]) for r in quality.scored(now.drop("own"), models).filter("keep").select(*p.COLUMNS).collect())
    first = p.classify(spark, now, str(tmp_path))
    assert got(first, *p.COLUMNS) == keep and first.columns == p.COLUMNS
    second = p.deduplicate(spark, first, str(tmp_path))
    before, after = first.collect(), second.collect()
    groups = {(r[0], f): c for r, (_, f, c) in zip(before, brute_components(before))}
    named = [r for r in after if r.doc_id is not None]
    assert all(groups[r.doc_id, simhash.fingerprint(r.text)] == r.doc_id for r in named)
    classes = {}
    for r, c in zip(before, brute_classes(before)):
        classes.setdefault(c, []).append(r)
    assert len(after) == len(classes) and all(sum(tuple(r) in set(map(tuple, g)) for r in after) == 1 for g in classes.values())
    third = p.redact(spark, second, str(tmp_path))
    assert third.count() == second.count() and third.filter("text like '%token = abc%'").count() == 0
    assert third.columns == p.COLUMNS
    fourth = p.mix(spark, third, str(tmp_path))
    uses = {(r.doc_id, r.text): r.n for r in mixing.mix(third).select("doc_id", "text", F.size(F.filter("mix.passes", lambda x: x["words"] > 0)).alias("n")).collect()}
    counts = defaultdict(int)
    for r in fourth.collect():
        counts[r.doc_id, r.text] += 1
    assert counts == {k: n for k, n in uses.items() if n}
    last = p.encode(spark, fourth, str(tmp_path))
    digest = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    assert got(last, "doc_id", "decoded_sha256") == sorted(repr((r.doc_id, digest(r.text))) for r in fourth.collect())
    assert got(p.run(spark, str(tmp_path)), "doc_id", "n_pieces", "ids_sha256") == got(last, "doc_id", "n_pieces", "ids_sha256")


def test_pipeline_of_an_empty_table(spark, empty, tmp_path):
    import corpus_pipeline as p

    empty.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert p.run(spark, str(tmp_path)).count() == 0


def test_queries_have_oracles_that_agree(spark):
    import os

    import duckdb

    from maskwright.llm import entries

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("no test tables")
    for name, sql in entries.ORACLES.items():
        con = duckdb.connect()
        for t in ("documents", "embeddings"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
        want = con.sql(sql)
        rows = entries.QUERIES[name](spark, sf)
        order = sorted(rows.columns)
        assert order == sorted(want.columns)
        assert sorted(map(repr, map(tuple, rows.select(*order).collect()))) == sorted(map(repr, con.sql(f"SELECT {', '.join(order)} FROM ({sql})").fetchall()))


