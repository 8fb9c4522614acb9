"""Each operator against a brute-force version, on small tables with nulls, ties, repeated rows and clashing names."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from reelsift.llm.fingerprint_log import FingerprintLog
from reelsift.llm import op1_quality, op2_mixing, op3_decontamination, op4_lines, op5_token_files, op6_substring, op7_minhash, op8_images, op9_html, op10_chat

SCHEMA = "doc_id long, text string, source string, size long"
VOCABULARY = [f"w{i}é" if i % 9 == 0 else f"w{i}" for i in range(3000)]


def documents(n=60):
    r = random.Random(3)
    rows = [(i, " ".join(r.choices(VOCABULARY, k=r.randint(1, 120))), f"s{i % 3}", 0) for i in range(n)]
    for i in range(0, 12, 2):
        words = rows[i][1].split()
        rows.append((100 + i, " ".join([*words[: len(words) // 2], "changed", *words[len(words) // 2 :]]), None, 0))
    rows += [(200, None, "s1", 0), (201, "", "s1", 0), (202, "", None, 0), (None, "lone words", "s2", 0), rows[5], rows[5], (203, "One two\nThree  four!\nOne two", "s0", 0), (204, "x " * 5000, "s0", 0), (205, "a b <|endoftext|> \x1c  c\n\n d  ", "s0", 0)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(documents(), SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain_words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def water(items, total, most):
    """Targets by weight of (name, words, weight), none above ``most`` times its words, by resharing until none is."""
    out, free = {}, list(items)
    while free:
        level = (total - sum(out.values())) / sum(w for _, _, w in free)
        over = [x for x in free if level * x[2] > most * x[1]]
        if not over:
            return out | {n: level * w for n, _, w in free}
        out |= {n: most * words for n, words, _ in over}
        free = [x for x in free if x not in over]
    return out


def test_mixing(spark, docs, empty):
    out = op2_mixing.mix_sources(docs).collect()
    sizes = collections.Counter()
    for r in out:
        assert r.size == len(words(r.text)) and r.taken == r.copies * r.size <= 2 * r.size and (r.size or not r.copies)
        sizes[r.source] += r.size
    names = sorted(sizes, key=lambda x: (x is None, x))
    want = water([(n, sizes[n], (5, 2, 1)[i % 3]) for i, n in enumerate(names) if sizes[n]], 1.5 * sum(sizes.values()), 2)
    for r in out:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * want[r.source]
    for s in names:
        assert abs(sum(r.expected * r.size for r in out if r.source == s) - want[s]) < 1e-6 * want[s]
    # near the targets where no document is most of its source and no row is repeated
    even = op2_mixing.mix_sources(docs.where("doc_id < 200").dropDuplicates(["doc_id"])).collect()
    for s, target in {r.source: r.target for r in even}.items():
        assert abs(sum(r.taken for r in even if r.source == s) - target) <= 60
    assert sorted(out, key=str) == sorted(op2_mixing.mix_sources(docs).collect(), key=str)
    mixed = op2_mixing.mixed(docs.withColumn("row", F.lit("x")).withColumn("n", F.lit(1)).withColumn("cut", F.lit(2)))
    assert mixed.columns == [*docs.columns, "row", "n", "cut"] and mixed.count() == sum(r.copies for r in out) and mixed.where("size <> 0").isEmpty()
    assert op2_mixing.mix_sources(empty).count() == 0 and op2_mixing.mixed(empty).count() == 0


def test_mixing_inclusion_frequencies(spark):
    """Short documents are taken as often as their expected copies say, and so are long ones."""
    rows = [(i, " ".join(["w"] * (20 if i % 2 else 400)), "a" if i < 4000 else "b") for i in range(6000)]
    out = op2_mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string"), total=0.6)
    seen = {(r.source, r.size): r for r in out.groupBy("source", "size").agg(F.avg("copies").alias("got"), F.avg("expected").alias("want")).collect()}
    assert all(seen[x, 20].want > seen[x, 400].want for x in "ab")
    for r in seen.values():
        assert abs(r.got - r.want) < 0.04, r


@pytest.mark.parametrize("block", [20, 100_000])
def test_decontamination(spark, docs, empty, block):
    rows = documents()
    items = [(1, " ".join(rows[7][1].upper().split()[:20])), (2, "lone, words"), (3, None), (4, "!!"), (10, " ".join(rows[7][1].split()[4:16])), (4, "One two three")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    windows = {}
    for i, t in items:
        w = plain_words(t)
        k = min(8, len(w))
        for j in range(len(w) - k + 1 if k else 0):
            windows.setdefault(tuple(w[j : j + k]), set()).add(str(i))
    for r in op3_decontamination.find_leaks(docs, bench, block_words=block).collect():
        w, hit, named = plain_words(r.text), set(), set()
        for k in {len(x) for x in windows}:
            for j in range(len(w) - k + 1):
                if own := windows.get(tuple(w[j : j + k])):
                    hit |= set(range(j, j + k))
                    named |= own
        assert (r.n_words, r.n_hit, r["items"]) == (len(w), len(hit), sorted(named))
        assert plain_words(r.clean) == [x for j, x in enumerate(w) if j not in hit]
    assert op3_decontamination.find_leaks(docs, bench.where("false")).where("n_hit > 0").isEmpty()
    assert op3_decontamination.find_leaks(empty, bench).count() == 0


def test_lines(spark, docs, empty):
    r = random.Random(5)
    lines = [" ".join(r.sample(VOCABULARY, r.randint(1, 12))) for _ in range(60)]
    near = lambda x: " ".join([*x.split()[1:], "new"]) if r.random() < 0.5 else x
    rows = [(i, "\n".join(near(r.choice(lines)) for _ in range(6)) + "\n \n") for i in range(40)] + [(77, None), (78, "")]
    report = {x.doc_id: x for x in op4_lines.line_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    seen = []
    for i, text in sorted(rows):
        kept = []
        for place, line in enumerate([] if text is None else text.lower().split("\n")):
            own = set(line.split(" ")) - {""}
            if not own or not any(len(own & x) >= 0.8 * len(own | x) - 1e-9 for x in seen):
                kept.append(place)
            if own:
                seen.append(own)
        assert report[i].kept == kept and report[i].n_removed == report[i].n_lines - len(kept)
    assert op4_lines.line_report(empty).count() == 0
    assert {r.doc_id: r.text for r in op4_lines.dedup_lines(docs).collect()}[200] is None


def test_lines_of_a_large_group(spark, monkeypatch):
    """Long similar lines, and short and long ones that meet, without Python on executors and without all pairs of a group."""
    r = random.Random(9)
    base, pairs, own = [[f"g{k}w{i}" for i in range(n)] for k, n in enumerate([40, 64, 66, 150, 300])], [], op4_lines._similar
    other = lambda k: [x if j % 24 else f"e{r.randrange(10**9)}" for j, x in enumerate(base[k], r.randrange(24))]
    rows = [" ".join(base[0])] + [" ".join(other(0)) for _ in range(250)] + [" ".join(w) for w in base[1:]] + [" ".join(other(k)[r.randrange(9) :]) for k in (1, 2, 3, 4) * 15]
    monkeypatch.setattr(op4_lines, "_similar", lambda p, *more: pairs.append(p.count()) or own(p, *more))
    for name in ("mapInArrow", "mapInPandas"):
        monkeypatch.setattr(type(spark.range(1)), name, None)
    report = op4_lines.line_report(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).collect()
    sets = [set(x.split(" ")) for x in rows]
    want = {i for i, x in enumerate(sets) if any(len(x & y) >= 0.8 * len(x | y) - 1e-9 for y in sets[:i])}
    assert {x.doc_id for x in report if x.n_similar} == {x.doc_id for x in report if x.n_removed} == want and 250 <= len(want) < len(rows) - 5
    assert sum(pairs) < 8 * len(rows)


def test_line_sets(spark):
    """Words are sorted as values that can't be null, marks differ in no more parities than sets in words, and lines are lower-cased one by one as whole texts are."""
    r = random.Random(3)
    lines = [" ".join(r.choices(VOCABULARY, k=r.randint(1, 40))) for _ in range(40)] + ["\u039f\u0394\u039f\u03a3 \u03a3", "\u03a3\u03b1 \u0130x \u1e9e", "\u039f\u0394\u039f\u03a3"]
    docs = spark.createDataFrame([(i, " \n".join(lines[i : i + 3]).title()) for i in range(len(lines))], "key long, text string").withColumn("h", F.xxhash64("text"))
    sets = op4_lines._sets(docs, op4_lines._levels(docs), 0.8)
    assert not sets.schema["codes"].dataType.containsNull
    rows, lowered = sets.collect(), {x.key: x.text.split("\n") for x in docs.select("key", F.lower("text").alias("text")).collect()}
    words = [set(lowered[x.key][x.place].split(" ")) - {""} for x in rows]
    bits = lambda x: (x.m1 % (1 << 64)) << 64 | x.m2 % (1 << 64)
    seen = {}
    for x, w in zip(rows, words, strict=True):
        assert x.n == len(w) and (bits(x).bit_count() - x.n) % 2 == 0 and seen.setdefault(frozenset(w), (x.c1, x.c2, x.m1, x.m2)) == (x.c1, x.c2, x.m1, x.m2)
    assert all((bits(x) ^ bits(y)).bit_count() <= len(v ^ w) for x, v in zip(rows, words, strict=True) for y, w in zip(rows, words, strict=True))
    assert len({(x.c1, x.c2) for x in rows}) == len(seen)


def test_token_files(spark, docs, empty):
    library = Tokenizer.from_file(op5_token_files.public_tokenizers.path("byte_bpe_50k.json"))
    found = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in op5_token_files.token_index(docs).collect())
    rows = sorted(documents(), key=lambda r: (r[0] is not None, r[0] or 0))
    start = 0
    for (at, key, n, crc), (own, text, _, _) in zip(found, rows, strict=True):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        assert (at, key, n, crc) == (start, own, len(ids), zlib.crc32(ids.tobytes()))
        start += n
    assert op5_token_files.token_index(empty).count() == 0
    for bits in (1, 7, 15, 16, 17, 31):
        ids = np.random.default_rng(bits).integers(0, 1 << bits, 1000).astype(np.uint32)
        image = op5_token_files.TokenImage(op5_token_files.image([3], [1000], ids, bits, 64))
        assert (image.ids() == ids).all() and (image.ids(63, 130) == ids[63:130]).all()


@pytest.mark.parametrize("width", [4, 35])
def test_substrings(spark, docs, empty, width):
    rows = documents()
    count = collections.Counter(tuple(w[i : i + width]) for _, t, _, _ in rows for w in [words(t)] for i in range(len(w) - width + 1))
    for r in op6_substring.remove_repeats(docs, width=width).collect():
        w = words(r.text)
        gone = {j for i in range(len(w) - width + 1) if count[tuple(w[i : i + width])] > 1 for j in range(i, i + width)}
        assert (r.n_words, r.n_removed, r.kept) == (len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone))
    assert op6_substring.remove_repeats(empty).count() == 0


def test_fingerprint_log(spark, tmp_path):
    batches, count = [[1, 2, 2, 3], [3, 4, 4], [5, 1], [6, 6, 2], [7]], collections.Counter()
    log = FingerprintLog(spark, f"file://{tmp_path}/log", fanout=2)
    for k, fps in enumerate(batches):
        new = log.add(spark.createDataFrame([(x, 1) for x in fps], "fp long, n int"))
        count.update(fps)
        assert sorted(r.fp for r in new.collect()) == sorted({x for x in fps if count[x] > 1})
        assert len(log.runs) <= 2
        if k == 2:  # goes on where another stopped
            log = FingerprintLog(spark, log.path, fanout=2, runs=log.runs)
    assert {r.fp: r.n for r in log.merged().collect()} == {x: min(n, 2) for x, n in count.items()}


def test_clashing_names(spark):
    rows = [(i, f"alpha beta gamma delta {i // 2} epsilon\nlast line of {i // 3} here", f"s{i % 2}") for i in range(8)] + [(None, None, None), (3, "", "s1")]
    odd = ["row", "key", "h", "s", "t", "k1", "k2", "_spans", "_text", "c", "id", "n", "first", "grade", "rated", "_h", "_k", "_g", "_kept", "carried", "copies", "text_", "line.s"]
    docs = spark.createDataFrame([(*r, *range(len(odd))) for r in rows], "doc_id long, text string, source string, " + ", ".join(f"`{x}` long" for x in odd))
    want = {x: i for i, x in enumerate(odd)}
    keep = lambda df: [tuple(r[x] for x in odd if x != "copies") for r in df.collect()]
    same = tuple(v for x, v in want.items() if x != "copies")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(8)], "doc_id long, quality int, toxic int")
    for out, n in (
        (op2_mixing.mix_sources(docs), 10), (op4_lines.dedup_lines(docs), 10), (op6_substring.remove_repeats(docs, width=3), 10),
        (op3_decontamination.find_leaks(docs, docs.select(F.col("doc_id").alias("item_id"), "text")), 10),
        (op1_quality.score(docs, op1_quality.train(docs, op1_quality.graded(labels))), 10), (op7_minhash.keep_one(docs), None),
    ):
        found = keep(out)
        assert set(found) == {same} and (n is None or len(found) == n)


def near_groups(rows):
    """For each (key, text), the number of the first row that it is connected with by similar texts: all pairs are compared."""
    bags = [collections.Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else collections.Counter() for _, t in rows for w in [plain_words(t)]]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            shared = sum((bags[i] & bags[j]).values())
            total = sum(bags[i].values()) + sum(bags[j].values()) - shared
            if (rows[i][1] is not None and rows[i][1] == rows[j][1]) or rows[i] == rows[j] or total and shared >= 0.8 * total:
                old, new = root[i], root[j]
                root = [new if x == old else x for x in root]
    return root


def test_near_copies(spark, docs, empty):
    rows = documents()
    expected = collections.defaultdict(list)
    for i, x in enumerate(near_groups([r[:2] for r in rows])):
        expected[x].append(rows[i][0])
    want = sorted((str(min((k for k in v if k is not None), default=None)), len(v)) for v in expected.values() for _ in v)
    assert sorted((str(r.class_id), r.copies) for r in op7_minhash.near_duplicates(docs).collect()) == want
    assert op7_minhash.near_duplicates(empty).count() == 0
    kept = op7_minhash.keep_one(docs)
    assert kept.columns == docs.columns and kept.where("doc_id = 5").count() == 1 and kept.where("doc_id between 100 and 120").count() < 6


def test_near_copies_of_a_template(spark):
    r = random.Random(7)
    frame = [f"f{i}" for i in range(160)]
    rows = []
    for g in range(100):
        own = [f"g{g}x{i}" for i in range(24)]
        rows += [(2 * g + k, " ".join([*frame, *own, *(f"v{r.getrandbits(40)}" for _ in range(12))])) for k in range(2)]
    bags = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for _, t in rows for w in [t.split()]]
    alike = lambda a, b: len(a & b) >= 0.8 * len(a | b)
    assert all(alike(bags[i], bags[j]) == (i // 2 == j // 2) for i in range(200) for j in range(i))
    # few bands of one row, so that most texts share a bucket and few of them lead it
    out = op7_minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), bands=6, rows=1).collect()
    assert sorted((r.doc_id, r.class_id, r.copies) for r in out) == [(i, i // 2 * 2, 2) for i in range(200)]


def test_bag_signatures_estimate_weighted_jaccard():
    r = np.random.default_rng(1)
    values = r.integers(0, 1 << 63, 200).astype(np.uint64)
    a, b = r.integers(1, 9, 200), r.integers(1, 9, 200)
    text = np.repeat([0, 1], 200)
    point = op7_minhash.signatures(np.concatenate([values, values]), text, np.concatenate([a, b]), 2, 4096)
    assert abs((point[0] == point[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.04


def test_quality(spark, empty):
    r = random.Random(2)
    texts = [(i, " ".join(r.choices(VOCABULARY[:300], k=60)) + (" vile" if i % 5 == 0 else "") + (" junk!!" * 20 if i % 5 == 1 else "")) for i in range(1400)] + [(None, None), (9999, "")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 0 if i % 5 == 1 else 1, 1 if i % 5 == 0 else 0) for i in range(1000)] + [(1, None, None), (None, 1, 0)], "doc_id long, quality int, toxic int")
    model = op1_quality.train(docs, op1_quality.graded(labels))
    assert (np.diff(model.thresholds) > 0).all()
    held = [x for x in op1_quality.score(docs, model).collect() if x.doc_id is not None and 1000 <= x.doc_id < 1400]
    assert np.mean([x.keep == (x.doc_id % 5 > 1) for x in held]) > 0.95
    assert op1_quality.score(empty, model).count() == 0
    nothing = op1_quality.train(docs, op1_quality.graded(labels.where("false")))
    assert op1_quality.score(docs, nothing).where("not keep").isEmpty()


def test_images(spark):
    r = np.random.default_rng(4)
    rows = [(i, r.normal(0, 0.12, 64).tolist()) for i in range(60)]
    rows += [(100, rows[0][1]), (101, None)]
    out = {x.vec_id: x for x in op8_images.copy_search(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert all(out[i].found for i in (0, 20, 40)) and out[0].n_members == 2 and out[20].n_copies == 1
    assert op8_images.copy_search(spark.createDataFrame([], "vec_id long, embedding array<double>")).count() == 0


def test_image_copies_are_found_after_edits():
    r = np.random.default_rng(5)
    images = [np.kron(np.clip(128 + 400 * v, 0, 255).reshape(8, 8), np.ones((12, 12))).astype(np.uint8).astype(float) for v in r.normal(0, 0.125, (40, 64))]
    index = [op8_images.points(g, (1.0,)) for g in images]
    edits = {
        "noise": lambda g: np.clip(g + r.normal(0, 10, g.shape), 0, 255), "half": lambda g: g[:, :48], "turned": lambda g: np.rot90(g), "upside down": lambda g: np.rot90(g, 2),
        "smaller": lambda g: op8_images._resized(g, 0.75), "larger": lambda g: op8_images._resized(g, 1.5), "darker": lambda g: g * 0.6,
    }
    for name, edit in edits.items():
        found = [[op8_images.agreeing(asked, x) >= op8_images.AGREE for x in index] for asked in (op8_images.points(np.rint(edit(g)), op8_images.SCALES) for g in images[::2])]
        assert sum(own[2 * k] for k, own in enumerate(found)) >= 18, name
        assert sum(map(sum, found)) - sum(own[2 * k] for k, own in enumerate(found)) <= 1, name


def test_image_search_of_odd_images(spark):
    r = np.random.default_rng(6)
    good = np.kron(r.integers(0, 255, (8, 8)), np.ones((12, 12))).astype(np.uint8).tobytes()
    rows = [(1, 96, 96, good), (2, 96, 96, good), (3, None, 96, good), (4, 96, 96, None), (5, 0, 0, b""), (6, 4, 4, b"0" * 16), (7, 90, 96, good)]
    images = spark.createDataFrame(rows, "id long, width int, height int, pixels binary")
    out = {x.id: x for x in op8_images.find_copies(images, images.unionByName(images)).collect()}
    assert len(out[1].copies) == 1 and out[1].copies == out[2].copies and all(out[i].copies == [] and out[i].n_points == 0 for i in (3, 4, 5, 6, 7))
    assert op8_images.edited(images.where("id = 4")).first().pixels is None


@pytest.mark.parametrize("name", ["op2_source_mix", "op3_decontamination", "op4_line_dedup", "op6_substring_dedup", "op7_minhash", "op10_chat_format"])
def test_queries_match_sql(spark, name):
    import duckdb

    from reelsift.llm import queries

    sf = "/root/testdata/sf0.001"
    with duckdb.connect() as con:
        for t in ("documents", "benchmark", "conversations"):
            con.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
        sql = con.sql(queries.ORACLE_SQL[name])
        columns, want = sql.columns, sql.fetchall()
    found = queries.QUERIES[name](spark, sf)
    assert sorted(found.columns) == sorted(columns)
    assert sorted(map(str, (tuple(r[c] for c in columns) for r in found.collect()))) == sorted(map(str, want))


LONG = "This is the text of the page that is here for all of us to read and it has the words that it needs. "


@pytest.mark.parametrize("page", ["<a " * 300_000, "<li>a" * 100_000, '<a "' * 200_000, "<a b='" * 100_000, "<div>" * 80_000 + "</p>" * 80_000, "<td>" * 100_000])
def test_html_in_linear_time(page):
    import time

    start = time.time()
    op9_html.extract(page)
    assert time.time() - start < 5


@pytest.mark.parametrize(
    "page",
    [
        f'<div class="content has-sidebar"><p>{LONG}', f'<div class="post no-comments"><p>{LONG}</div>', f'<body><li class="share">x<p>{LONG}', f"<article><h2><a href=x>Teaser</a></h2></article><div><p>{LONG}",
        f"<article><header><h1></h1></header><p>{LONG}</article>", f'<a href="x>link</a><p>{LONG}', f'<p>{LONG}<span class="ad">Buy <span>now</span></span>', f"<nav><ul><li>one<li>two</ul></nav><p>{LONG}<footer>{LONG}</footer>",
    ],
)
def test_html_hints(page):
    assert LONG.strip() in op9_html.extract(page) and "Buy" not in op9_html.extract(page) and "one" not in op9_html.extract(page) and op9_html.extract(page).count("This is") == 1


def test_html_densities_decide(monkeypatch):
    junk = "Lorem xq ipsvm dolr zit amqt consecq adipz elitq sedq eiuzmod temqor incidz labqre dolqre magnq aliqz. "
    page = f"<body><div>{junk}</div><div>{LONG}</div><div>Short one.</div><div>{LONG}</div><div><a href=x>{LONG}</a></div><div>{junk}</div></body>"
    assert op9_html.extract(page) == "\n".join([LONG.strip(), "Short one.", LONG.strip()])
    assert op9_html.extract("<p>One short paragraph.") == "One short paragraph."
    assert op9_html.extract(f"<p>{junk}") == junk.strip()  # a language without known stop words
    monkeypatch.setattr(op9_html, "STOP", frozenset())
    assert junk.strip() in op9_html.extract(page)


def test_html_given_pages():
    """The given pages have one article of headings and paragraphs, which a plain rule finds."""
    import html

    import pyarrow.parquet as pq

    for row in pq.read_table("/root/testdata/sf0.001/pages.parquet").to_pylist():
        body = re.search(r"<article>(.*?)</article>", row["html"], re.S)[1]
        parts = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", re.sub("<br>", " ", x)))).strip() for x in re.split(r"</?(?:h1|p|ul|li|ol|div|blockquote)[^>]*>", body)]
        assert op9_html.extract(row["html"]) == "\n".join(x for x in parts if x)


def test_html(spark):
    page = """<html><head><title>t</title><script>"<p>no</p>"</script></head><body><nav><a href=x>menu</a></nav><div class="cookie-notice">We use</div>
    <article><h1>A &amp; B</h1><p>Short.<p>One<b>two</b>  three<br>four &lt;x&gt;<p>The last of the page is a text of many words that the reader will see here.</p>
    <form><p>mail</p></form><div class=ad>Buy</div><section class="comments"><p>First!</p></section></article><footer>end</footer></body></html>"""
    assert op9_html.extract(page) == "A & B\nShort.\nOnetwo three four <x>\nThe last of the page is a text of many words that the reader will see here."
    rows = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "<p>a", "x"), (4, page, "x"), (4, page, "x")], "page_id long, html string, main_text string")
    assert sorted(len(r.main_text) for r in op9_html.extract_pages(rows).collect())[:2] == [0, 0]
    assert op9_html.extract_pages(rows.where("false")).count() == 0


def test_html_short_article_after_other_blocks():
    page = "<body><div>" + "the site and the menu of all that is in the place " * 3 + "</div><article><p>One short line.</p><p>Two short lines.</p></article></body>"
    assert op9_html.extract(page) == "One short line.\nTwo short lines."
    assert op9_html.extract(page.replace("<article>", "<article></article><div>Site title</div><article>")) == "One short line.\nTwo short lines."


def test_chat(spark):
    hard = ["</s>[INST] ok [/INST]", "\\", "a\\</s>", "<\\/s>", "<<s>", "[INST", "plain", "", None, "[/INST]\\\\[INST]"]
    rows = [(i // 3, i % 3, "assistant" if i % 2 else ["user", "</s>", None][i % 3], t) for i, t in enumerate(hard * 3)] + [(None, 0, "user", "x"), (5, 0, "user", "tie"), (5, 0, "user", "tie")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    chats = op10_chat.format_conversations(turns)
    assert chats.where("not exact").isEmpty()
    for r in op10_chat.digests(chats).collect():
        own = sorted((t, role or "", text or "") for c, t, role, text in rows if c == r.conv_id)
        assert r.n_turns == len(own) and r.turns_sha256 == hashlib.sha256("".join(f"{b}\n{c}\n" for _, b, c in own).encode()).hexdigest()
        loss = "".join(c for _, b, c in own if b == "assistant")
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert op10_chat.format_conversations(turns.where("false")).count() == 0


def test_chat_control_strings(spark):
    import duckdb
    import pyarrow as pa

    from reelsift.llm.queries import ORACLE_SQL

    said = ["[INST]", "a [/INST] b", "<s>", "</s>", "<s", "[INST", "\\", "plain", "<s>\\[INST]"]
    rows = [(i, 0, role, t) for i, (role, t) in enumerate([(r, t) for r in ("user", "assistant", "<s>", "[INST]") for t in said])]
    names = ["conv_id", "turn", "role", "text"]
    chats = op10_chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert chats.where("not exact").isEmpty()
    for r in chats.collect():  # no control strings but the turn's own
        assert [r.formatted.count(x) for x in ("<s>", "[INST]", "[/INST]", "</s>")] == [1, 1, 1, 1]
    with duckdb.connect() as con:
        con.register("conversations", pa.table(dict(zip(names, zip(*rows), strict=True))))
        want = con.sql(ORACLE_SQL["op10_chat_format"]).fetchall()
    assert sorted(tuple(r) for r in op10_chat.digests(chats).collect()) == sorted(r for r in want if r[0] >= 0)


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """The smallest tables with planted copies, benchmark passages and runs, toxic documents, nulls and clashing names."""
    folder, sf = tmp_path_factory.mktemp("planted"), "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    items = spark.read.parquet(f"{sf}/benchmark.parquet").orderBy("item_id").limit(3).collect()
    toxic = [r.text for r in docs.join(labels.where("toxic = 1"), "doc_id").orderBy("doc_id").collect()]
    good = [r.text for r in docs.join(labels.where("quality = 1 and toxic = 0"), "doc_id").where("n_chars between 600 and 4000").orderBy("doc_id").collect()]
    run = " ".join(plain_words(items[1].text)[:9])
    texts = [
        *toxic, good[0], good[0].replace(" ", "  ", 3), good[1] + " added", f"{good[2]} {items[0].text} {good[3]}", f"{good[4][:500]} {run.upper()}! {good[5]}",
        None, None, "", "short", " ".join(good) * 20, good[6], good[6],
    ]
    made = [(9000 + i, x, None if i % 5 == 0 else "src1", "en", None if x is None else len(x)) for i, x in enumerate(texts)]
    extra = spark.createDataFrame([*made, made[-1], (None, good[7], "src2", None, None)], "doc_id long, text string, source string, lang string, n_chars long")
    odd = {x: F.lit(x) for x in ("keep", "clean", "n_hit", "items", "expected_grade", "size", "taken", "id", "c0", "c1", "row", "a.b")}
    docs.unionByName(extra.select(*docs.columns)).withColumns(odd).write.parquet(f"{folder}/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{sf}/{t}.parquet").write.parquet(f"{folder}/{t}.parquet")
    return str(folder), [9000 + i for i in range(len(toxic))], 9000 + len(toxic)


def test_pipeline(spark, planted):
    """Each stage against a brute-force version of it on what the stage before it kept."""
    import duckdb
    import pyarrow as pa

    import corpus_pipeline
    from reelsift.llm.queries import ORACLE_SQL

    folder, toxic, first = planted
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)
    shown = lambda rows: sorted(map(str, map(tuple, rows)))

    def after(name):
        nonlocal docs
        before = docs.collect()
        docs = spark.createDataFrame(stages[name](spark, docs, folder).collect(), docs.schema)
        assert docs.columns == columns
        return before, docs.collect()

    before, rows = after("quality classifier")
    # the texts one at a time, by the probabilities written out
    model = op1_quality.train(spark.createDataFrame(before, docs.schema), op1_quality.graded(spark.read.parquet(f"{folder}/labels.parquet")))
    score = lambda t: sum(float(model.weights[f]) for f in op1_quality.features([(t or "").encode()], len(model.weights))[1])
    assert shown(rows) == shown(r for r in before if 1 / (1 + np.exp(model.thresholds[-1] - score(r.text))) >= 0.5) and not {r.doc_id for r in rows} & set(toxic)
    rated = {r.doc_id: r for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert np.mean([(r.doc_id in {x.doc_id for x in rows}) == (rated[r.doc_id].quality == 1 and rated[r.doc_id].toxic == 0) for r in before if r.doc_id in rated]) > 0.95

    before, rows = after("MinHash near-dedup")
    groups = collections.defaultdict(list)
    for r, x in zip(before, near_groups([(r.doc_id, r.text) for r in before]), strict=True):
        groups[x].append(r)
    least = [min(x, key=lambda r: (r.doc_id is None, r.doc_id or 0)) for x in groups.values()]
    assert shown(rows) == shown(least) and len(rows) < len(before) and not {first, first + 1, first + 2} & {r.doc_id for r in rows}

    before, rows = after("benchmark decontamination")
    windows = {tuple(w[i : i + k]) for x in spark.read.parquet(f"{folder}/benchmark.parquet").collect() for w in [plain_words(x.text)] for k in [min(8, len(w))] if k for i in range(len(w) - k + 1)}
    want = {}
    for r in before:
        w = plain_words(r.text)
        hit = {j for k in {len(x) for x in windows} for i in range(len(w) - k + 1) if tuple(w[i : i + k]) in windows for j in range(i, i + k)}
        if len(hit) < 16:
            want[r.doc_id] = (r, [x for j, x in enumerate(w) if j not in hit], bool(hit))
    assert sorted(map(str, want)) == sorted(str(r.doc_id) for r in rows) and first + 3 not in want and want[first + 4][2]
    for r in rows:
        old, left, cut = want[r.doc_id]
        assert plain_words(r.text) == left and (r.n_chars == len(r.text) if cut else r == old)
        assert [r[c] for c in columns if c not in ("text", "n_chars")] == [old[c] for c in columns if c not in ("text", "n_chars")]

    before, rows = after("mixing sources to target weights")
    with duckdb.connect() as con:
        con.register("documents", pa.table({"doc_id": pa.array([r.doc_id for r in before], pa.int64()), "text": [r.text for r in before], "source": [r.source for r in before]}))
        taken = {r["doc_id"]: r for r in con.sql(ORACLE_SQL["op2_source_mix"]).arrow().read_all().to_pylist()}
    assert len(taken) == len(before)
    assert shown(rows) == shown(r for r in before if taken[r.doc_id]["size"] for _ in range(taken[r.doc_id]["taken"] // taken[r.doc_id]["size"]))

    library = Tokenizer.from_file(op5_token_files.public_tokenizers.path("byte_bpe_50k.json"))
    want, start = [], 0
    for r in sorted(rows, key=lambda r: (r.doc_id is not None, r.doc_id or 0)):
        ids = np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4")
        want.append((r.doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    names = ("doc_id", "start", "n_tokens", "ids_crc32")
    assert shown(corpus_pipeline.run(spark, folder).select(*names).collect()) == shown(want)


def test_pipeline_of_empty_tables(spark, planted, tmp_path):
    import corpus_pipeline

    folder = planted[0]
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{t}.parquet").where("false").write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name in ("quality classifier", "benchmark decontamination"):  # nothing is rated, nothing leaks
        assert dict(corpus_pipeline.STAGES)[name](spark, docs, str(tmp_path)).count() == docs.count()
