import io
import json
import tarfile

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from reelsift.functions import audio, captions, probe, vision
from reelsift.__main__ import main
from reelsift.functions.numbers import positive, ratio, rounded, weighted_mean
from reelsift.operators import similarity
from reelsift.operators.policy import FilterPolicy, apply_policy
from reelsift.operators.similarity import annotate
from reelsift.plans import queries
from reelsift.plans.config import load_settings
from reelsift.plans.batch import PUBLIC
from reelsift.sources import clips, storage
from reelsift.sources.media import Backends

SF = "/root/testdata/sf0.001"


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values()) or (0,)], list(values) or ["_"])
    return row.select(column.alias("x")).first().x


def test_probe_takes_the_first_shown_video(spark):
    cover = {"codec_type": "video", "codec_name": "mjpeg", "width": 9, "disposition": {"attached_pic": 1}}
    film = {"codec_type": "video", "codec_name": " vp9", "width": "640", "height": 360, "avg_frame_rate": "0/0", "r_frame_rate": "50/2"}
    payload = {"format": {"duration": "7.25", "bit_rate": "N/A"}, "streams": [cover, {"codec_type": "audio", "codec_name": "opus", "duration": "7"}, film]}
    read = probe.parse_payload(F.col("p"), F.lit(10))
    p = one(spark, read, p="\n " + json.dumps(payload))
    assert (p.video_codec, p.width, p.fps, p.duration_sec, p.audio_duration_sec, p.has_audio, p.probe_error) == ("vp9", 640, 25.0, 7.25, 7.0, True, None)
    assert one(spark, read, p='{"format": {}, "format": {"duration": 3}}').probe_error is None  # a repeated key
    for bad in ("oops", "[1]", "", '{"a": 1} more', '{"a"'):
        assert one(spark, read, p=bad).probe_error, bad
    reasons = one(spark, probe.technical_reasons(probe.parse_payload(F.col("p"), F.lit(0)), probe.TechnicalPolicy()), p="{}")
    assert reasons == ["unreadable"]
    block = one(spark, probe.technical_block(read, F.array().cast("array<string>"), 24.0), p=json.dumps(payload).replace(" vp9", "H265"))
    assert (block.codec, block.fps_processed) == ("hevc", 24.0)


def test_numbers(spark):
    values = {"0/0": None, "N/A": None, "": None, "30000/1001": 30000 / 1001, "25": 25.0, "1d": None}
    for text, expected in values.items():
        assert one(spark, ratio(F.col("x")), x=text) == expected
    assert one(spark, positive(F.col("x")), x="-1") is None
    with pytest.raises(ValueError):
        weighted_mean([(F.lit(1.0), 0.0)])


def test_captions(spark):
    said = "The cat sat; catalogue, CAT"
    assert one(spark, captions.replace_words(F.col("c"), {"cat": "dog$1"}), c=said) == "The dog$1 sat; catalogue, dog$1"
    assert one(spark, captions.replace_words(F.col("c"), {"cat": "<\\g<0>>\\n"}), c="a Cat") == "a <Cat>\n"
    assert one(spark, captions.replace_words(F.col("c"), {"thé": "eau"}), c="du thé, théâtre") == "du eau, théâtre"
    with pytest.raises(ValueError):
        captions.template("\\1")
    assert one(spark, captions.reply_score(F.col("r"), "a"), r='so: {"a": "47"} ok') == 0.47
    assert one(spark, captions.reply_score(F.col("r"), "a"), r="no object") is None
    labels = ("tree", "other")
    assert [one(spark, captions.content_label(F.col("c"), labels), c=x) for x in ("\n\u00a0Tree\t", "bush")] == ["tree", "other"]
    assert one(spark, captions.object_key(F.lit(" "), F.col("c")), c="n") == "n"
    assert one(spark, rounded(F.col("x"), 3), x=0.0625) == 0.062


def test_timestamps(spark):
    t = one(spark, probe.frame_timestamps(F.col("d"), 4), d=10.0)
    assert len(t) == 4 and t[0] == 0.05 and abs(t[3] - 9.95) < 1e-9
    assert one(spark, probe.frame_timestamps(F.col("d"), 1), d=3.0) == [1.5]
    assert one(spark, probe.frame_timestamps(F.col("d"), 4), d=0.0) == []


@pytest.mark.parametrize("n", [100, 1024, 1500, 2048, 5000])
def test_audio_frames(spark, n):
    x = np.sin(np.arange(n) / 7) * 0.3
    pad = np.concatenate([np.zeros(1024), x, np.zeros(1024)])
    rms = [np.sqrt((pad[k * 512 : k * 512 + 2048] ** 2).sum() / 2048) for k in range(n // 512 + 1)]
    row = audio.analyze(spark.createDataFrame([(1, i, float(v)) for i, v in enumerate(x)], "clip_id long, i long, x double")).first()
    assert abs(row.rms - np.mean(rms)) < 1e-6 and row.clipping_ratio == 0


def test_audio_in_numpy(spark):
    x = np.clip(np.sin(np.arange(5000) / 3) * 1.2, -1, 1)
    row = audio.analyze(spark.createDataFrame([(1, i, float(v)) for i, v in enumerate(x)], "clip_id long, i long, x double")).first()
    assert audio.measured(x) == {k: row[k] for k in ("silence_ratio", "rms", "clipping_ratio", "audio_quality")}
    assert audio.measured(np.zeros(700))["silence_ratio"] == 1
    with pytest.raises(ValueError):
        audio.measured([])


def test_frames():
    r = np.random.default_rng(3)
    flat, busy = np.full((40, 60, 3), 90, np.uint8), r.integers(0, 256, (40, 60, 3)).astype(np.uint8)
    (dull, _, no_text), (rich, _, _) = vision.measured([flat]), vision.measured([busy])
    assert dull < rich and no_text == 0
    # strokes in few columns of some rows; narrow frames have as many places as the window
    page = np.zeros((20, 50, 3), np.uint8)
    page[4:8, 10:14:2] = 255
    gray = page.astype(np.float32) @ vision.LUMA
    strong = np.abs(np.diff(gray, axis=1)) >= 25
    want = sum((np.convolve(row, np.ones(21), "same") > 0).sum() for row in strong.astype(float) if 0.05 < row.mean() < 0.35) / (20 * 49)
    assert want > 0 and vision.measured([page])[2] == pytest.approx(want)
    narrow = page[:, 5:17]
    strong = np.abs(np.diff(narrow.astype(np.float32) @ vision.LUMA, axis=1)) >= 25
    want = sum((np.convolve(row, np.ones(21), "same") > 0).sum() for row in strong.astype(float) if 0.05 < row.mean() < 0.35) / (20 * 11)
    assert vision.measured([narrow])[2] == pytest.approx(min(1, want))
    # a mark that stays in one corner, in frames of unequal size too
    marked = [flat.copy(), flat.copy()[:30]]
    for x in marked:
        x[:6, :10:2] = 255
    assert vision.measured(marked)[1] == 1 and vision.measured([marked[0], flat])[1] < 0.5
    assert abs(np.linalg.norm(vision.histogram([busy])) - 1) < 1e-6 and not vision.histogram([]).any()
    counts = np.concatenate([np.histogram(busy[::8, ::8, c], 16, (0, 255))[0] for c in range(3)])
    assert np.allclose(vision.histogram([busy]), counts / np.linalg.norm(counts))
    assert vision.rgb(np.ones((4, 4))).tolist() == np.full((4, 4, 3), 255).tolist() and vision.clip_facts([])[-1] == "frame_extraction_failed"


def test_similarity(spark):
    rows = [(0, "b", [1.0, 0.0]), (1, "a", [1.0, 0.0]), (2, "c", [0.0, 1.0]), (3, "d", None)]
    out = {r.video_id: r for r in annotate(spark.createDataFrame(rows, "clip_idx long, video_id string, embedding array<float>")).collect()}
    assert out["b"].canonical_id == out["a"].canonical_id == "a" and out["a"].deduplication.is_near_duplicate
    assert out["b"].deduplication.nearest_video_id == "a" and out["c"].content.cluster_size == 1
    assert out["d"].deduplication.nearest_video_id is None and [out[k].deduplication.cluster_id for k in "bacd"] == [0, 0, 1, 2]


def test_policy_nan_and_null_reject_nothing(spark):
    rows = queries._records(queries._views(spark, SF, queries.METRIC, "orders")).withColumn("visual", F.struct(F.lit(None).cast("double").alias("aesthetic_score"), F.lit(float("nan")).alias("watermark_probability"), F.lit(0.1).alias("text_area_ratio")))
    out = apply_policy(rows.where("technical_reasons is null"), FilterPolicy(min_aesthetic=0.5, max_watermark=0.5, max_silence_ratio=None, max_clipping_ratio=None))
    assert out.where("filtering.status = 'rejected'").isEmpty()


def test_config():
    s = load_settings("")
    assert (s.filtering.min_fps, s.filtering.max_duration, s.dedup.cluster_similarity, s.output_dir, len(s.content.labels)) == (8, 7200, 0.92, "reports", 8)
    assert s.policy().max_clipping_ratio == 0.02 and not s.policy().reject_near_duplicates and s.technical().codecs[0] == "h264"
    s = load_settings("extensions: [.MP4]\nfiltering: {max_text_area_ratio: null, min_width: 32, reject_labels: [ Text ]}\nframes: {count: 2}")
    assert s.policy().max_text_area is None and s.technical().min_width == 32 and s.policy().reject_labels == ("text",) and s.frames.count == 2
    for bad in (
        "nope: 1", "filtering: {min_fps: true}", "filtering: {min_duration: 9, max_duration: 1}", "content: {labels: [a]}", "filtering: {min_fsp: 3}", "frames: 4", "frames: {count: 0}", "audio: {sample_rate: 8000.5}",
        "storage: {enabled: true}", "storage: {read_videos: true}", "vlm: {backend: qwen_vl, judge_model_id: Qwen/Qwen3-VL-8B-Instruct}", "video_text: {replace_words: {' ': x}}", "filtering: {reject_labels: [moon]}",
        "audio: {weight_silence: 0, weight_energy: 0, weight_clipping: 0}", "- 1",
    ):
        with pytest.raises(ValueError):
            load_settings(bad)


def _clip_folder(folder):
    """Clips as text files that the tools of ``TOOLS`` read."""
    folder.mkdir()
    for name in ("good", "twin", "dark", "mute", "odd", "lost"):
        (folder / f"{name}.mp4").write_text(name)
    (folder / "empty.mov").write_text("")
    (folder / "note.txt").write_text("no clip")
    return folder


def _tool_probe(settings):
    def read(path):
        name = path.rsplit("/", 1)[1].split(".")[0]
        if name == "lost":
            raise RuntimeError("not a film")
        streams = [{"codec_type": "video", "codec_name": "h264", "width": 640, "height": 480, "avg_frame_rate": "30/1"}]
        return json.dumps({"format": {"duration": "5"}, "streams": streams + [{"codec_type": "audio", "duration": "5"}] * (name != "mute")})

    return read


def _tool_frames(settings):
    def read(path, times):
        r = np.random.default_rng(1)
        if "odd" in path:
            return [np.zeros((2, 2, 2, 2))]
        return [np.zeros((64, 64, 3), np.uint8) if "dark" in path else r.integers(0, 256, (64, 64, 3)).astype(np.uint8) for _ in times]

    return read


TOOLS = Backends(probe=_tool_probe, frames=_tool_frames, audio=lambda s: lambda path, start, length: np.sin(np.arange(16000) / 5) * 0.2)


def test_batch_of_a_folder(spark, tmp_path, capsys):
    folder = _clip_folder(tmp_path / "in")
    code = main(["run", "--input", str(folder), "--output-dir", str(tmp_path / "out"), "--backends", "tests.test_clips:TOOLS"])
    assert code == 0 and "7 clips: 3 accepted, 4 rejected, 0 errors" in capsys.readouterr().out
    rows = [json.loads(x) for f in sorted((tmp_path / "out" / "results.jsonl").glob("part-*")) for x in f.read_text().splitlines()]
    found = {r["video_id"]: r for r in rows}
    assert all(list(r) == list(PUBLIC) for r in rows) and len(rows) == 7
    assert {k: r["filtering"]["reasons"] for k, r in found.items() if r["filtering"]["reasons"]} == {
        "dark": ["aesthetic_score_below_threshold"], "empty": ["unreadable"], "lost": ["unreadable"], "odd": ["visual_extraction_failed"],
    }
    assert found["good"]["deduplication"]["is_near_duplicate"] and found["good"]["deduplication"]["cluster_id"] == found["twin"]["deduplication"]["cluster_id"]
    assert found["mute"]["audio"] == dict.fromkeys(("silence_ratio", "rms", "clipping_ratio", "audio_quality")) and found["good"]["audio"]["rms"] > 0.1
    assert main(["run", "--input", str(folder), "--output-dir", str(tmp_path)]) == 2 and main(["run"]) == 2 and main(["run", "--input", str(folder), "--limit", "0"]) == 2


def test_store(spark, tmp_path):
    folder, root = _clip_folder(tmp_path / "in"), f"file://{tmp_path}/store"
    for archive in ("tar", "files"):
        s = load_settings(f"storage: {{enabled: true, bucket: b, archive: {archive}}}")
        places = storage.upload_clips(spark, str(folder), s, root=root)
        assert len(places) == (1 if archive == "tar" else 7)
        if archive == "tar":
            with tarfile.open(tmp_path / "store/videos/videos.tar") as t:
                assert sorted(t.getnames()) == sorted(x.name for x in folder.iterdir() if x.suffix != ".txt") and t.extractfile("good.mp4").read() == b"good"
        down = tmp_path / f"down-{archive}"
        assert storage.download_clips(spark, s, f"file://{down}", root=root).count() == 7 and (down / "dark.mp4").read_text() == "dark"
    s.storage.videos_prefix = "files/md5"
    with pytest.raises(ValueError):
        storage.upload_clips(spark, str(folder), s, root=root)
    s.storage.videos_prefix, s.storage.archive = "none", "tar"
    with pytest.raises(FileNotFoundError):
        storage.download_clips(spark, s, f"file://{tmp_path}/x", root=root)
    (tmp_path / ".dvc").mkdir()
    (tmp_path / ".dvc/config").write_text("['remote \"s3\"']\n    url = s3://bucket/some/where/\n    endpointurl = http://x\n")
    assert storage.remote_settings(str(folder)) == {"bucket": "bucket", "prefix": "some/where", "endpoint": "http://x", "key": "", "secret": ""}
    with pytest.raises(ValueError):
        clips.guard_prefix("some/where/files/a", "some/where")


def test_ids(spark):
    names = ["a/b.mp4", "c/b.mp4", "x/a__b.mp4", "x__a__b.mp4", "y/c__b.mp4", "z/solo.mov"]
    out = clips.identified(spark.createDataFrame([(n, "/" + n) for n in reversed(names)], "source string, path string")).orderBy("clip_idx").collect()
    assert [(r.clip_idx, r.source) for r in out] == [*enumerate(sorted(names, key=lambda n: n.split("/")))]
    assert {r.source: r.video_id for r in out} == {"a/b.mp4": "a__b", "c/b.mp4": "c__b", "x/a__b.mp4": "x__a__b", "x__a__b.mp4": "x__a__b", "y/c__b.mp4": "y__c__b", "z/solo.mov": "solo"}
    assert clips.identified(spark.createDataFrame([(n, "/" + n) for n in names], "source string, path string"), 2).count() == 2


def test_similarities_by_shuffle(spark, monkeypatch):
    r = np.random.default_rng(2)
    rows = [(i, r.normal(size=3).tolist()) for i in range(50)] + [(60, [1.0]), (61, [2.0]), (62, None), (63, [])]
    df = spark.createDataFrame(rows, "clip_idx long, embedding array<float>").repartition(5)
    monkeypatch.setattr(similarity, "BLOCK", 8)
    monkeypatch.setattr(similarity, "MOST_BYTES", 0)
    found = similarity.similarities(df, 1.0).cache()
    v = {i: np.array(x, np.float32) for i, x in rows if x}
    sims = {(a, b): float(v[a] @ v[b]) for a in v for b in v if a != b and len(v[a]) == len(v[b])}
    assert sorted((x.a, x.b) for x in found.where("link").collect()) == sorted(p for p, x in sims.items() if p[0] < p[1] and x >= 1)
    best = {x.clip_idx: x.nearest_idx for x in similarity.nearest(found).collect()}
    assert best == {a: max((b for b in v if (a, b) in sims), key=lambda b: sims[a, b]) for a in v}


def test_sources(spark, tmp_path):
    (tmp_path / "a").mkdir()
    for name in ("a/x.MP4", "x.mov", ".y.mp4", "n.txt"):
        (tmp_path / name).write_bytes(b"")
    out = clips.identified(clips.clips_only(clips.list_files(spark, str(tmp_path)))).orderBy("clip_idx").collect()
    assert [(r.source, r.video_id) for r in out] == [(".y.mp4", ".y"), ("a/x.MP4", "a__x"), ("x.mov", "x")]
    with tarfile.open(tmp_path / "t.tar", "w") as t:
        info = tarfile.TarInfo("clips/a.mp4")
        info.size = 3
        t.addfile(info, io.BytesIO(b"abc"))
        t.addfile(tarfile.TarInfo("n.txt"))
    assert [(r.source, r.length) for r in clips.read_archives(spark, str(tmp_path / "t.tar")).collect()] == [("clips/a.mp4", 3)]
    for bad in ("", "files/x", "/"):
        with pytest.raises(ValueError):
            clips.guard_prefix(bad)
    with pytest.raises(ValueError):
        clips.guard_output("/o/in", "/o")


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_match_sql(spark, name):
    con = duckdb.connect()
    for t in ("part", "orders", "events", "documents", "embeddings", "lineitem"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    found = queries.QUERIES[name](spark, SF)
    columns = sorted(found.columns)
    plain = lambda v: round(float(v), 6) if isinstance(v, float) or type(v).__name__ == "Decimal" else v
    rows = sorted((tuple(plain(r[c]) for c in columns) for r in found.collect()), key=str)
    sql = con.sql(queries.ORACLE_SQL[name])
    assert sorted(sql.columns) == columns
    expected = sorted((tuple(plain(v) for _, v in sorted(zip(sql.columns, r, strict=True))) for r in sql.fetchall()), key=str)
    assert rows == expected


def _brute(rows, levels):
    """By definition: nearest other row, links of the least level, and each level's least connected ids, in double precision."""
    v = {i: np.array(x, np.float32).astype(float) for i, x in rows if x and np.isfinite(x).all()}
    sims = {(a, b): sum((v[a] * v[b]).tolist()) for a in v for b in v if a != b and len(v[a]) == len(v[b])}
    near = {a: min((-s, b) for (x, b), s in sims.items() if x == a) for a in {a for a, _ in sims}}
    roots = []
    for least in levels:
        root = {i: i for i, _ in rows}
        for (a, b), s in sims.items():
            if s >= least and root[a] != root[b]:
                low, high = sorted((root[a], root[b]))
                root = {i: low if x == high else x for i, x in root.items()}
        roots.append(root)
    return {a: (b, -s) for a, (s, b) in near.items()}, {p: s for p, s in sims.items() if p[0] < p[1] and s >= levels[0]}, roots


def _odd_vectors():
    r = np.random.default_rng(4)
    some = [*np.round(r.normal(size=(12, 3)) * 0.7, 2).tolist(), [0.0, 0.0, 0.0], [0.3, 0.0, 0.0], [1e-20, 0.0, 0.0]]
    rows = [(3 * k, some[k * k % 15]) for k in range(90)] + [(1, [2.0]), (2, [2.0]), (4, [0.1]), (5, [0.1, 0.2]), (7, None), (8, []), (10, [float("nan"), 0.0, 1.0]), (11, [float("inf"), 1.0, 1.0])]
    return rows


@pytest.mark.parametrize("block", [8, 2048])
def test_links_and_nearest_of_copies(spark, monkeypatch, block):
    monkeypatch.setattr(similarity, "BLOCK", block)
    rows = _odd_vectors()
    near, links, _ = _brute(rows, [0.5])
    found = similarity.similarities(spark.createDataFrame(rows, "clip_idx long, embedding array<float>").repartition(3), 0.5)
    assert {(x.a, x.b): round(x.sim, 9) for x in found.where("link").collect()} == {p: round(s, 9) for p, s in links.items()} and found.where("link").count() == len(links)
    assert {x.clip_idx: (x.nearest_idx, round(x.sim, 9)) for x in similarity.nearest(found).collect()} == {a: (b, round(s, 9)) for a, (b, s) in near.items()}


def test_double_precision_decides(spark):
    # single precision rounds 1 + 2 ** -25 to 1
    rows = [(0, [1.0, 1.0]), (1, [1.0, 0.0]), (2, [1.0, 2.0**-25])]
    found = similarity.similarities(spark.createDataFrame(rows, "clip_idx long, embedding array<float>"), 1 + 2.0**-26)
    assert {x.clip_idx: x.nearest_idx for x in similarity.nearest(found).collect()} == {0: 2, 1: 0, 2: 0}
    assert [(x.a, x.b) for x in found.where("link").collect()] == [(0, 2)]


def test_pairs_of_tiles_are_tasks(spark, monkeypatch):
    monkeypatch.setattr(similarity, "BLOCK", 8)
    monkeypatch.setattr(similarity, "MOST_BYTES", 0)
    r = np.random.default_rng(6)
    rows = [(i, r.normal(size=3).tolist()) for i in range(64)]
    found = similarity._compared(similarity._distinct(spark.createDataFrame(rows, "clip_idx long, embedding array<float>").coalesce(1))[0].coalesce(1), [9.0], True)
    assert len(found.inputFiles()) >= 36  # of 8 tiles
    # no row is in many more results than there are tiles
    assert found.groupBy("a").count().agg(F.max("count")).first()[0] <= 8


@pytest.mark.parametrize("block", [8, 2048])
def test_clusters_of_copies(spark, monkeypatch, block):
    monkeypatch.setattr(similarity, "BLOCK", block)
    rows, levels = _odd_vectors(), [0.2, 0.6, 0.9]
    near, _, (content, cluster, same) = _brute(rows, levels)
    df = spark.createDataFrame([(i, f"v{i:03}", x) for i, x in rows], "clip_idx long, video_id string, embedding array<float>")
    out = {r.clip_idx: r for r in annotate(df.repartition(3), 0.6, 0.9, 0.2).collect()}
    assert sorted(out) == sorted(i for i, _ in rows)
    for i, x in out.items():
        size = lambda root: sum(y == root[i] for y in root.values())
        assert x.content.cluster_size == size(content) and x.content.cluster_id == sorted({*content.values()}).index(content[i])
        assert x.deduplication.cluster_id == sorted({*cluster.values()}).index(cluster[i])
        assert x.canonical_id == f"v{same[i]:03}"
        b, s = near.get(i, (None, None))
        assert x.deduplication.nearest_video_id == (None if b is None else f"v{b:03}") and x.deduplication.is_near_duplicate == (b is not None and s >= 0.9)


def test_parts_are_what_links_connect():
    r = np.random.default_rng(7)
    u, v, level = r.integers(0, 300, 260), r.integers(0, 300, 260), r.integers(0, 3, 260)
    parts = similarity._Parts(300, [0.1, 0.2, 0.3])
    for k in range(0, 260, 50):
        parts.add(u[k : k + 50], v[k : k + 50], level[k : k + 50])
        parts.fold()
    links = [*parts.links()]
    assert sum(len(a) for _, a, _ in links) < 300
    for k in range(3):
        want, got = (similarity._merged(np.arange(300), *(np.concatenate(x) for x in zip(*pairs, strict=True))) for pairs in ([(u[level >= k], v[level >= k])], [(a, b) for n, a, b in links if n >= k]))
        assert (want == got).all()


def test_batch_deals_clips_and_counts_copies_once(spark, tmp_path, monkeypatch):
    from reelsift.plans import batch as plan

    monkeypatch.setattr(plan, "CLIPS_OF_TASK", 20)
    made = []
    monkeypatch.setattr(plan, "extract_facts", lambda clips, *a, f=plan.extract_facts: made.append(clips.rdd.getNumPartitions()) or f(clips, *a))
    monkeypatch.setattr(similarity, "_compared", lambda distinct, *a, f=similarity._compared: made.append(distinct.count()) or f(distinct, *a))
    spark.read.parquet(f"{SF}/part.parquet").withColumn("p_partkey", F.explode(F.array("p_partkey", F.col("p_partkey") + 5120))).coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    rows = queries.batch(spark, str(tmp_path)).select("video_id", "size", "near", "nearest").collect()
    assert len(rows) == 400 and made[0] == 20 and made[1] <= 200 and sum(r.near for r in rows) > 200
