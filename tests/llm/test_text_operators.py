import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from ridgeline.llm import bpe, grulm, licenses, packing, quality, sharding, simhash, suffix, toxicity
from ridgeline.llm.queries import tokenizer_files
from ridgeline.llm.shared import boxed

SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def low(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


# --- licenses


def test_license_scan_counts_every_place(docs, rows):
    got = licenses.scanned(docs, ["doc_id"]).collect()
    assert len(got) == len(rows)
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def plain(t):
        w = word.findall(low(t))
        hit = [(i, label) for p, label in licenses.PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
        return len(w), len(hit), min((i for i, _ in hit), default=None), max((i for i, _ in hit), default=None), ",".join(sorted({x for _, x in hit}))

    assert Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got) == Counter((i, *plain(t)) for i, t in rows)
    by_id = {r.doc_id: r for r in got}
    assert "mit-notice" in by_id[45].labels and by_id[45].score > 0.5
    assert "gpl-3.0-notice" in by_id[46].labels


def as_regex(items):
    """A template as a regular expression over words, each with a space before; written apart from the automaton."""
    out = ""
    for item in items:
        if item[0] == "word":
            out += " " + re.escape(item[1])
        elif item[0] == "one":
            out += " (?:" + "|".join(map(re.escape, item[1])) + ")"
        elif item[0] == "any":
            out += r"(?: [^ ]+){%d,%d}" % item[1:]
        else:
            out += f"(?:{as_regex(item[1])})?"
    return out


@pytest.mark.parametrize("label", sorted(licenses.TEMPLATES))
def test_template_automaton_is_its_regex(label):
    import random

    rng = random.Random(label)
    automaton = next(a for by in licenses.compiled({label: licenses.TEMPLATES[label]}).values() for a in by)
    items = licenses.parse(licenses.TEMPLATES[label])
    while items[0][0] == "any" or items[0][0] == "optional" and all(i[0] == "any" for i in items[0][1]):
        items = items[1:]

    def sample(items):
        out = []
        for i in items:
            if i[0] == "word":
                out.append(i[1])
            elif i[0] == "one":
                out.append(rng.choice(i[1]))
            elif i[0] == "any":
                out += ["filler"] * rng.randint(i[1], i[2])
            elif rng.random() < 0.6:
                out += sample(i[1])
        return out

    pattern = re.compile(as_regex(items) + "(?= |$)")
    hits = 0
    for _ in range(60):
        text = ["the"] + sample(items) + ["end"]
        if rng.random() < 0.4:
            text[rng.randrange(len(text))] = "other"
        m = pattern.match(" " + " ".join(text[1:]))
        found = automaton.match(text, 1)
        assert (m is not None) == (found is not None)
        hits += m is not None
    assert hits > 10


def test_template_markup_errors():
    for bad in ("<<beginOptional>> license", "license <<endOptional>>", '<<var;name="x";original="y">> license', "no anchor here"):
        with pytest.raises(ValueError):
            licenses.compiled({"bad": bad})


# --- suffix arrays


def naive_suffix_array(x):
    return sorted(range(len(x)), key=lambda i: x[i:])


def test_suffix_array_on_random_and_periodic():
    import random

    rng = random.Random(1)
    for _ in range(600):
        n = rng.randint(0, 50)
        x = [rng.randint(1, rng.choice([1, 2, 3, 9])) for _ in range(n)]
        if rng.random() < 0.4:
            x = (x[:4] * 20)[:n]
        assert suffix.suffix_array([*x, 0]) == naive_suffix_array([*x, 0])


def brute_repeats(rows, width=50):
    last = np.iinfo(np.int64).max
    seen, out = {}, []
    texts = [(last if i is None else i, (t or "").encode()) for i, t in rows]
    for i, b in texts:
        for p in range(len(b) - width + 1):
            w = b[p : p + width]
            seen[w] = min(seen.get(w, last), i)
    for i, b in texts:
        gone = bytearray(len(b))
        for p in range(len(b) - width + 1):
            if seen[b[p : p + width]] < i:
                gone[p : p + width] = b"\1" * width
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        runs = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((None if i == last else i, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize(("block_bytes", "hot"), [(1 << 14, 1024), (3 << 19, 1024), (1 << 14, 2)])
def test_suffix_dedup_is_brute_force(docs, rows, block_bytes, hot):
    got = suffix.deduplicated(docs.select("doc_id", "text"), ["doc_id"], block_bytes=block_bytes, hot=hot).withColumn("sha", F.sha2("kept", 256)).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.sha) for r in got) == brute_repeats(rows)
    assert all(sum(s["end"] - s["start"] for s in r.spans) == r.n_removed for r in got)


def test_suffix_dedup_keeps_other_columns_and_whole_characters(docs, rows):
    got = suffix.deduplicated(boxed(docs), ["_row", "doc_id", "text"], as_text=True).collect()
    assert len(got) == len(rows) and all(r._row["bucket"] == "b" for r in got)
    assert all(len(r.kept_text.encode()) >= len(r.kept) for r in got)


# --- quality


def brute_statistics(t):
    w = SPACED.findall(t or "")
    tri = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    marked = {i + k for i in range(len(w) - 2) if tri[tuple(w[i : i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in (t or "").split("\n"):
        if SPACED.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), dup, len(marked)


def labels_of(spark, pairs):
    return spark.createDataFrame(pairs, "doc_id long, quality int, toxic int")


def test_quality_statistics_and_rule(spark, docs, rows):
    labels = labels_of(spark, [(i, int(i % 3 > 0), 0) for i in range(50)] + [(None, 1, 1), (7, None, None)])
    got = quality.judged(docs, quality.fitted(docs, labels), ["doc_id"]).collect()
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == Counter((i, *brute_statistics(t)) for i, t in rows)
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_trees_learn_and_are_monotonic():
    rng = np.random.default_rng(0)
    x = rng.random((3000, len(quality.FEATURES)))
    signs = np.array(list(quality.FEATURES.values()))
    y = (x[:, 0] - 0.8 * x[:, 4] + 0.1 * rng.normal(size=3000) > 0).astype(float)
    trees = quality.grown(x, y, signs)
    assert ((trees.score(x) > 0.5) == y).mean() > 0.93
    for f in np.flatnonzero(signs):
        probe = np.repeat(rng.random((40, 1, x.shape[1])), 30, axis=1)
        probe[:, :, f] = np.linspace(-1, 2, 30)
        p = trees.score(probe.reshape(-1, x.shape[1])).reshape(40, 30)
        assert (signs[f] * np.diff(p, axis=1) >= -1e-12).all()
    # flattened arrays walk as the trees do
    one = x[:50]
    total = np.full(50, trees.start)
    for feature, cut, leaf in zip(trees.feature, trees.cut, trees.leaf, strict=True):
        for r in range(50):
            k = 0
            while k < len(feature):
                k = 2 * k + 1 + int(one[r, feature[k]] > cut[k])
            total[r] += leaf[k - len(feature)]
    assert np.allclose(trees.score(one), 1 / (1 + np.exp(-total)))


# --- SimHash


def brute_fingerprint(t):
    w = low(t).encode().split()
    shingles = [b" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or ([b" ".join(w)] if w else [])
    bits = [sum(xxhash.xxh64_intdigest(s, 42) >> j & 1 for s in shingles) for j in range(64)]
    return sum(1 << j for j in range(64) if 2 * bits[j] > len(shingles))


def test_simhash_groups_are_brute_force(docs, rows):
    got = simhash.grouped(docs, "doc_id").collect()
    fp = [brute_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))
    for _ in rows:
        for i, a in enumerate(fp):
            for j, b in enumerate(fp):
                if bin(a ^ b).count("1") <= 4:
                    root[i] = min(root[i], root[j])
    least = defaultdict(list)
    for r, (i, _) in zip(root, rows, strict=True):
        if i is not None:
            least[r].append(i)
    want = Counter((i, f - (1 << 64) if f >> 63 else f, min(least[r], default=None)) for (i, _), f, r in zip(rows, fp, root, strict=True))
    assert Counter((r.doc_id, r.fp, r.component) for r in got) == want


def test_bit_slices_and_refinement(spark):
    rng = np.random.default_rng(5)
    fps = rng.integers(0, 1 << 64, 400, dtype=np.uint64)
    fps[:200] &= np.uint64(0xFFFF)  # many share most of their bits
    for k in range(100, 200):
        fps[k] = fps[k - 100] ^ (np.uint64(1) << rng.integers(0, 16, dtype=np.uint64))
    fps = np.unique(fps)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4
    label = np.arange(len(fps))
    while True:
        new = np.where(near, label[None, :], len(fps)).min(1)
        if (new == label).all():
            break
        label = new
    frame = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    parent = {int(x): int(x) for x in fps.view(np.int64)}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for r in simhash.links(frame, refine_over=30).collect():
        parent[top(r.u)] = top(r.v)
    got = [top(int(x)) for x in fps.view(np.int64)]
    assert len(set(got)) == len(set(label)) and len(set(zip(got, label.tolist(), strict=True))) == len(set(got))


# --- tokens and packing


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_files()[0])


@pytest.mark.parametrize("fast", [True, False])
def test_bpe_is_the_library(docs, rows, library, fast):
    paths = tokenizer_files() if fast else (tokenizer_files()[0], None)
    part = docs if fast else docs.where("n_chars < 2000 or n_chars is null")
    got = bpe.encoded(part, ["doc_id"], *paths).collect()
    want = []
    for i, t in rows:
        if not fast and t is not None and len(t) >= 2000:
            continue
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == Counter(want)


def test_chunk_joins_on_hostile_texts(library):
    import random

    import pyarrow as pa

    from ridgeline.llm.shared import flat

    rng = random.Random(9)
    parts = ["a", "b", " ", "  ", "\n", "é", "ß", "'s", "'", "1", "²", "中", "😀", "<|endoftext|>", ".", "\x1c", "\x85", "́", "’", " word", "I'll"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 900))) for _ in range(150)]
    reuse = bpe.ChunkReuse(bpe.encoder(*tokenizer_files()))
    for t, b in zip(texts, reuse.batch(*flat(pa.array(texts))), strict=True):
        assert np.frombuffer(b, "<u2").tolist() == library.encode(t, add_special_tokens=False).ids


def test_chunks_are_reused():
    import pyarrow as pa

    from ridgeline.llm.shared import flat

    rng = __import__("random").Random(4)
    body = " ".join(rng.choice(["stone", "river", "light", "cloud"]) + rng.choice("abcdef") for _ in range(3000))
    reuse = bpe.ChunkReuse(bpe.encoder(*tokenizer_files()))
    reuse.batch(*flat(pa.array([body, "prefix words " + body, body + " tail"])))
    assert reuse.made < 0.5 * reuse.met


def test_hilbert_neighbours():
    cells = np.array([[a, b, c] for a in range(8) for b in range(8) for c in range(8)])
    key = packing.hilbert(cells, 3)
    assert sorted(key) == list(range(512))
    path = cells[np.argsort(key)]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


@pytest.mark.parametrize("bin_tokens", [1 << 12, 1 << 21])
def test_packing_lays_every_id_once(docs, rows, library, bin_tokens):
    got = packing.packed(docs, *tokenizer_files(), bin_tokens=bin_tokens).toPandas()
    assert sorted(got.groupby("sequence_id").length.sum().iloc[:-1].unique().tolist()) in ([2048], [])
    got = got.sort_values(["sequence_id", "offset"])
    assert ((got.offset + got.length).groupby(got.sequence_id).shift(fill_value=0) == got.offset).all()
    want = Counter((i if i is not None else -1, tuple([*library.encode(t or "", add_special_tokens=False).ids, 1])) for i, t in rows)
    laid, part, todo = Counter(), {}, None
    for r in got.itertuples():
        if r.start == 0:
            todo = []
        todo += np.frombuffer(r.ids, "<u4").tolist()
        assert zlib.crc32(r.ids) == r.ids_crc32
        if len(todo) == r.doc_tokens:
            laid[(-1 if r.doc_id != r.doc_id else int(r.doc_id), tuple(todo))] += 1
    assert laid == want


# --- sharding


def test_shards_follow_the_key(docs, rows):
    got = sharding.shuffled(docs, 5, bucket_bytes=1 << 12)
    assert set(got.columns) == {*docs.columns, "shard", "slot", "grown_shard"}
    out = got.toPandas()
    assert Counter(out.text.fillna("∅")) == Counter("∅" if t is None else t for _, t in rows)
    for _, g in out.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))
    assert ((out.grown_shard == out.shard) | (out.grown_shard == 5)).all()
    assert (out.groupby(out.doc_id.fillna(-1)).shard.nunique() == 1).all()
    again = sharding.shuffled(docs.repartition(7), 5, bucket_bytes=1 << 12).toPandas()
    key = lambda d: sorted(zip(d.doc_id.fillna(-1), d.text.fillna(""), d.shard, d.slot, strict=True))
    assert key(out) == key(again)  # whatever the partitions


def test_sharding_is_brute_force(spark, docs, rows):
    """Shards, grown shards and slots worked out again row by row, but for the order within a bucket."""
    got = sharding.shuffled(docs.select("doc_id", "text"), 5, bucket_bytes=1 << 12)
    n, size = len(rows), sum(len((t or "").encode()) for _, t in rows)
    buckets = -(-(size + sharding.ROW_BYTES * n) // ((1 << 12) * 5))
    assert buckets > 3
    hashed = spark.createDataFrame(rows, "doc_id long, text string").select(
        "doc_id", "text", F.xxhash64(F.lit(sharding.SEED + 1), "doc_id", "text").alias("c"), *(F.xxhash64(F.lit(sharding.SEED), F.lit(i), "doc_id").alias(f"h{i}") for i in range(6))
    )
    want: dict = {}
    for r in hashed.collect():
        shard, grown = (max((r[f"h{i}"], i) for i in range(k))[1] for k in (5, 6))
        want.setdefault((shard, r.c % buckets), []).append((r.doc_id or -1, r.text or "", grown))
    laid: dict = {}
    for r in got.collect():
        laid.setdefault(r.shard, {})[r.slot] = (r.doc_id or -1, r.text or "", r.grown_shard)
    moved = 0
    for s, of_shard in laid.items():
        at = 0
        for b in sorted(b for t, b in want if t == s):
            own = want[s, b]
            here = [of_shard[at + k] for k in range(len(own))]
            assert sorted(here) == sorted(own)
            moved += here != sorted(here)
            at += len(own)
        assert at == len(of_shard)
    assert moved > 0


def test_null_texts_fill_buckets(spark, tmp_path):
    many = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit(None).cast("string").alias("text"), F.create_map(F.lit("a"), F.lit(1)).alias("m"))
    got = sharding.shuffled(many, 2, bucket_bytes=1 << 16)
    assert got.count() == 20_000
    sharding.write_shards(many, f"{tmp_path}/shards", 2, bucket_bytes=1 << 16)
    back = spark.read.parquet(f"{tmp_path}/shards").withColumn("file", F.input_file_name())
    assert back.count() == 20_000
    per_shard = back.groupBy("shard").agg(F.count("*").alias("n"), F.min("slot").alias("lo"), F.max("slot").alias("hi"), F.count_distinct("slot").alias("d"), F.count_distinct("file").alias("files"))
    assert all(r.lo == 0 and r.hi == r.n - 1 and r.d == r.n and r.files > 1 for r in per_shard.collect())


# --- hashes of spans


@pytest.mark.parametrize("n", [1024, 2048, 4096])
def test_thue_morse_texts_are_told_apart(spark, n):
    """Such a text and its complement are alike for polynomials modulo a power of two, whatever the base."""
    a = "".join("ab"[bin(i).count("1") % 2] for i in range(n))
    b = a.translate({97: 98, 98: 97})
    rows = [(1, f"{a}\n{b}\n{a} {b} {a} {b}"), (2, f"{b}\n{a}"), (3, a), (4, b)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = quality.judged(docs, quality.fitted(docs, labels_of(spark, [])), ["doc_id"]).collect()
    assert Counter((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == Counter(brute_statistics(t) for _, t in rows)
    got = suffix.deduplicated(docs, ["doc_id"]).withColumn("sha", F.sha2("kept", 256)).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.sha) for r in got) == brute_repeats(rows)
    score = {r.doc_id: (r.n_tokens, r.n_known, r.train_tokens) for r in grulm.scored(docs).collect()}
    held = {i for i, _ in rows if zlib.crc32(str(i).encode()) % 7 == 2}
    n_train = sum(len(t.split()) + 1 for i, t in rows if i not in held)
    words = {w for i, t in rows if i not in held for w in t.split()}
    assert score == {i: (len(t.split()) + 1, sum(w in words for w in t.split()) + 1, n_train) for i, t in rows}


def test_names_of_outputs_are_refused(docs):
    for f in (lambda: quality.judged(docs, quality.Trees(*[__import__("numpy").zeros((0, 1))] * 3, 0.0), ["kept"]), lambda: toxicity.scored(docs, toxicity.Model([], None), ["score"])):
        with pytest.raises(ValueError, match="names of the output"):
            f()


# --- toxicity


def test_automaton_is_edit_distance():
    import random

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, prev = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(prev[j] + 1, row[j - 1] + 1, prev[j - 1] + (x != y)))
        return row[-1]

    rng = random.Random(2)
    terms = [toxicity.Term(t, s, e) for t, s, e in (("moron", False, 1), ("worthless", False, 2), ("scum", False, 0), ("lowei", True, 0), ("idiot", False, 1), ("idioten", True, 1))]
    automaton = toxicity.LexiconAutomaton(terms)
    pool = ["moron", "worthless", "scum", "lowei", "idiot", "idiotenxx", "loweischaft", "word", "mormon"]
    for _ in range(3000):
        w = list(rng.choice(pool))
        for _ in range(rng.randint(0, 3)):
            k = rng.randrange(len(w) + 1)
            w[k : k + rng.randint(0, 1)] = rng.choice(["", "a", "o", "x"])
        w = "".join(w)
        fits = []
        for n, t in enumerate(terms):
            d = min(edits(t.text, w[:k]) for k in range(len(w) + 1)) if t.stem else edits(t.text, w)
            if d <= t.edits:
                fits.append((d, n))
        assert automaton.match(w) == min(fits, default=None), w


def test_toxicity_learns_misspells_and_quotes(spark):
    rng = __import__("random").Random(8)
    fill = "the river runs by stone walls under morning light near old market towns".split()
    text = lambda *extra: " ".join(rng.choices(fill, k=40) + list(extra) + rng.choices(fill, k=10))
    rows = [(i, text("blorgus") if i % 5 == 0 else text()) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = labels_of(spark, [(i, 1, int(i % 5 == 0)) for i in range(600)])
    model = toxicity.fitted(docs, labels)
    assert [t.text for t in model.terms] == ["blorgus"]
    probe = spark.createDataFrame([(1, text("blorgus")), (2, text("blorrgus")), (3, text()), (4, text("he", "said", '"blorgus"', "and", "left")), (5, None), (6, "")], "doc_id long, text string")
    score = {r.doc_id: r.score for r in toxicity.scored(probe, model, ["doc_id"]).collect()}
    assert score[1] > 0.7 and score[2] > 0.3 > score[3] and score[4] < score[1] and score[5] == score[6] < 0.1


def test_empty_tables(spark, empty):
    none = labels_of(spark, [])
    assert licenses.scanned(empty, ["doc_id"]).count() == 0
    assert suffix.deduplicated(empty.select("doc_id", "text"), ["doc_id"]).count() == 0
    assert quality.judged(empty, quality.fitted(empty, none), ["doc_id"]).count() == 0
    assert simhash.grouped(empty, "doc_id").count() == 0
    assert bpe.encoded(empty, ["doc_id"], *tokenizer_files()).count() == 0
    assert packing.packed(empty, *tokenizer_files()).count() == 0
    assert sharding.shuffled(empty, 3).count() == 0
    assert toxicity.scored(empty, toxicity.fitted(empty, none), ["doc_id"]).count() == 0


def test_no_labels_scores_zero(spark, docs):
    got = toxicity.scored(docs, toxicity.fitted(docs, labels_of(spark, [])), ["doc_id"]).collect()
    assert max(r.score for r in got) < 1e-6


def test_quotations_pair_marks():
    def quoted(text):
        return {m.group() for m in re.finditer("[a-z]+", text) if any(a < m.start() < b for a, b in toxicity.quotations(text))}

    assert quoted("l’eau est froide et blorgus dans l’air") == set()
    assert quoted("the ‘blorgus’ and the dog’s bone") == {"blorgus"}
    assert quoted('she "one" two "three" four') == {"one", "three"}
    assert quoted("“one” two „drei“ vier «cinq» six »sieben« acht") == {"one", "drei", "cinq", "sieben"}
    assert quoted("“a ‘bb’ c” d") == {"a", "bb", "c"}
    assert quoted('open " never\nclosed " here') == set()
    assert quoted("vorher “ nachher “one” da") == {"one"}


def brute_score(text, terms, weights):
    """The score of a whole text, each word held against each term by edit distance, marks paired by scanning back."""
    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, prev = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(prev[j] + 1, row[j - 1] + 1, prev[j - 1] + (x != y)))
        return row[-1]

    text = low(text)
    words = [(m.group(), m.start(), m.end()) for m in re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)]
    hit = []
    for i, (w, s, e) in enumerate(words):
        fits = []
        for n, t in enumerate(terms):
            d = min(edits(t.text, w[:k]) for k in range(len(w) + 1)) if t.stem else edits(t.text, w)
            if d <= t.edits:
                fits.append((d, n))
        if not fits:
            continue
        lo, hi = words[max(0, i - 6)][1], words[min(len(words) - 1, i + 6)][2]
        reports = any(x in toxicity.REPORTING for x, _, _ in words[max(0, i - 6) : i + 7])
        inside = any(max(0, lo - 1) <= a < s and e <= b <= hi for a, b in toxicity.quotations(text))
        hit.append((*min(fits), inside or reports))
    kinds, plain = [{}, {}, {}], 0
    for d, n, q in hit:
        if sum(x[1] == n for x in hit) >= terms[n].need:
            kinds[2 if q else int(d > 0)][n] = terms[n].weight
            plain += not q
    exact, wrong, told = (sum(k.values()) for k in kinds)
    x = np.array([1, exact + 0.8 * wrong + 0.1 * told, wrong, told, np.log1p(plain)])
    return 1 / (1 + np.exp(-x @ weights))


def test_scores_of_whole_texts_are_brute_force(spark):
    import random

    rng = random.Random(13)
    terms = [toxicity.Term("blorgus", False, 1, 1, 1.3), toxicity.Term("worthless", False, 2, 1, 0.9), toxicity.Term("scum", False, 0), toxicity.Term("vile", True, 0, 2, 1.1)]
    model = toxicity.Model(terms, np.array([-3.0, 1.2, -0.3, 0.2, 0.7]))
    pool = ["blorgus", "blorgvs", "wortless", "worthles", "scum", "scun", "vilest", "vileness", "l’eau", "dog’s", "river", "stone", "said", "été", "Été"]
    marks = ["", "", "", "", "“", "”", '"', "«", "»", "‘", "’", ",", ".\n", "„"]
    rows = [(1, None), (2, ""), (3, "l’eau est froide et blorgus dans l’air"), (4, "“blorgus”")]
    rows += [(10 + i, " ".join(rng.choice(marks) + rng.choice(pool) + rng.choice(marks) for _ in range(rng.randint(1, 40)))) for i in range(250)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.score for r in toxicity.scored(docs, model, ["doc_id"]).collect()}
    for i, t in rows:
        assert got[i] == pytest.approx(brute_score(t, terms, model.weights)), t
    assert got[3] > 4 * got[4]


def test_document_ids_of_entries_are_small_once_compressed():
    """Entries hold ids by planes of bytes: compressed they take little more than the bytes that differ."""
    ids = np.random.default_rng(1).integers(0, 1 << 22, 5000)
    packed = suffix._planes(ids)
    assert (suffix._of_planes(packed) == ids).all() and (suffix._of_planes(suffix._planes(np.array([suffix._LAST, -5]))) == [suffix._LAST, -5]).all()
    assert len(pa.compress(packed, "lz4", asbytes=True)) < 0.8 * len(pa.compress(ids.astype("<i8").tobytes(), "lz4", asbytes=True))


def test_what_blocks_give_out_grows_with_the_input():
    columns = np.array([3, 1 << 40]), np.array([], np.int64), np.array([0, 0]), np.array([suffix._LAST, -5]), np.array([255], np.uint8)
    packed = suffix._packed(*columns)
    assert all((a == b).all() and len(a) == len(b) for a, b in zip(suffix._unpacked(packed), columns, strict=True))
    assert len(packed) == 4 + 8 * 5 + 2 * 6 + 2 * 8 + 1
    a, b = suffix._union(np.array([0, 10, 60, 200]), np.array([50, 60, 70, 250]))
    assert a.tolist() == [0, 200] and b.tolist() == [70, 250]
    # a row for each block and bucket, and for each block and array: what these take besides their content, at 6 GB (10 GB of text)
    total = 10 << 30
    blocks, buckets, arrays, _ = suffix.dealt(total, 200)
    assert blocks * (2 * buckets + arrays) * 100 < 0.4 * total
    # groups in parts give the same as all at once
    rng = np.random.default_rng(3)
    base = [bytes(rng.integers(97, 101, 90).astype(np.uint8)) for _ in range(20)]
    texts = [base[g][s : s + 60] for g, s in zip(rng.integers(0, 20, 300).tolist(), rng.integers(0, 30, 300).tolist(), strict=True)]
    docs, group = rng.integers(0, 40, 300), np.array([base.index(next(b for b in base if t in b)) for t in texts])
    assert suffix.in_parts(texts, docs, group, 500) == suffix.shared_windows(texts, docs, group)
