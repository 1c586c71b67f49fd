import json
import struct
import urllib.error
import zipfile

import pytest
from pyspark.sql import functions as F

from pagemill.schemas import PAGE_ASSET
from pagemill.sources import feeds, files, images


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


LINE = {"asset_id": "a", "transcript": "t", "polygon": [{"x": 1, "y": 2}], "confidence": 0.9}


@pytest.mark.parametrize(
    ("text", "n"),
    [(json.dumps([LINE, LINE]), 2), (json.dumps({"predictions": [LINE]}), 1), (json.dumps(LINE), 1), (json.dumps(LINE, indent=1), 1), (json.dumps(LINE) + "\n\n" + json.dumps(LINE) + "\n", 2), ("", 0), ("  \n", 0), (json.dumps({"predictions": []}), 0)],
)
def test_prediction_layouts(spark, tmp_path, text, n):
    got = files.read_predictions(spark, write(tmp_path / "p.json", text)).collect()
    assert len(got) == n and all(r["asset_id"] == "a" and r["confidence"] == 0.9 and tuple(r["polygon"][0]) == (1.0, 2.0) for r in got)


def test_unsupported_layout_fails(spark, tmp_path):
    with pytest.raises(Exception, match="unsupported"):
        files.read_predictions(spark, write(tmp_path / "p.json", "42")).collect()


def test_gold_defaults(spark, tmp_path):
    r = files.read_gold(spark, write(tmp_path / "g.jsonl", '{"image_path": "i"}\n\n')).collect()[0]
    assert (r["domain"], r["lang"], r["direction"], r["text_type"], r["split"], r["transcript"]) == ("manga", "mixed", "horizontal", "unknown", "train", "")


def test_jsonl_round_trip_keeps_nulls(spark, tmp_path):
    df = spark.createDataFrame([("é", None), (None, 1)], "a string, b int")
    files.write_jsonl(df, str(tmp_path / "out"))
    lines = [json.loads(x) for p in (tmp_path / "out").glob("part-*") for x in p.read_text().splitlines()]
    assert sorted(lines, key=str) == sorted([{"a": "é", "b": None}, {"a": None, "b": 1}], key=str)
    with pytest.raises(Exception):
        files.read_jsonl(spark, write(tmp_path / "bad.jsonl", "{nope"), "a string").collect()


def test_words_and_quotes(spark, tmp_path):
    head = "level\tpage_num\tblock_num\tpar_num\tline_num\tword_num\tleft\ttop\twidth\theight\tconf\ttext\n"
    r = files.read_words(spark, write(tmp_path / "w.tsv", head + '5\t1\t1\t1\t1\t1\t10\t10\t40\t20\t96\t"a\tb"\n')).collect()
    assert r[0]["text"] == "a\tb"


def test_export_tasks_report_archive(spark, tmp_path):
    t = [{"data": {"image_path": "i"}, "annotations": [{"result": []}]}, {"data": {"image_path": "j"}}]
    got = files.read_export(spark, write(tmp_path / "e.json", json.dumps(t))).collect()
    assert [(r["task_ord"], r["data"]["image_path"]) for r in got] == [(0, "i"), (1, "j")]
    tasks = spark.createDataFrame([('{"a": "é"}',), ('{"b": 1}',)], "task string")
    assert files.write_tasks(tasks, str(tmp_path / "x/tasks.json")) == 2
    assert sorted(map(str, json.loads((tmp_path / "x/tasks.json").read_text()))) == sorted(map(str, [{"a": "é"}, {"b": 1}]))
    assert files.write_tasks(tasks.limit(0), str(tmp_path / "none.json")) == 0 and json.loads((tmp_path / "none.json").read_text()) == []
    assert files.write_report(spark.range(1), str(tmp_path / "r.json")) == {"id": 0}
    out = write(tmp_path.parent / "outside.txt", "x")
    assert files.write_archive(str(tmp_path), [str(tmp_path / "x"), out, str(tmp_path / "missing")], str(tmp_path / "z.zip")) == ["x/tasks.json", "external/outside.txt"]
    assert zipfile.ZipFile(tmp_path / "z.zip").namelist() == ["x/tasks.json", "external/outside.txt"]


PNG = bytes.fromhex(images.PNG) + b"\x00\x00\x00\rIHDR" + struct.pack(">II", 100, 200)
JPG = b"\xff\xd8\xff\xe0\x00\x04ab\xff\xff\xc0\x00\x0b\x08" + struct.pack(">HH", 7, 9) + b"\x00"
RIFF = lambda kind, rest: b"RIFF\x00\x00\x00\x00WEBP" + kind + rest
VP8X = RIFF(b"VP8X", b"\x00" * 8 + (639).to_bytes(3, "little") + (479).to_bytes(3, "little"))
VP8L = RIFF(b"VP8L", b"\x00" * 5 + ((99) | (49 << 14)).to_bytes(4, "little") + b"\x00" * 9)
VP8 = RIFF(b"VP8 ", b"\x00" * 10 + struct.pack("<HH", 320, 240))


def test_fingerprints(spark, tmp_path):
    rows = [(1, PNG), (2, JPG), (3, VP8X), (4, VP8L), (5, VP8), (6, b"GIF89a"), (7, b""), (8, JPG[:6]), (9, None), (10, PNG[:20])]
    got = {r["id"]: r for r in images.fingerprint(spark.createDataFrame(rows, "id int, content binary")).collect()}
    assert [(got[i]["extension"], got[i]["width"], got[i]["height"]) for i in range(1, 9)] == [("png", 100, 200), ("jpg", 9, 7), ("webp", 640, 480), ("webp", 100, 50), ("webp", 320, 240), ("gif", None, None), ("bin", None, None), ("jpg", None, None)]
    assert got[10]["width"] is None and got[9]["sha256"] is None
    images.store(images.fingerprint(spark.createDataFrame(rows[:2] + rows[:1], "id int, content binary")), str(tmp_path))
    assert sorted(p.suffix for p in tmp_path.rglob("*.*")) == [".jpg", ".png"]


def test_difference_hash(spark):
    grey = [9 - c if r % 2 == 0 else c for r in range(8) for c in range(9)]
    got = spark.createDataFrame([(grey,), ([1, 2],), (None,)], "g array<int>").select(images.perceptual_hash(F.col("g")).alias("h")).collect()
    assert [r["h"] for r in got] == ["ff00ff00ff00ff00", None, None]


class Script:
    """A transport that answers from a list."""

    def __init__(self, *answers):
        self.answers, self.seen = list(answers), []

    def __call__(self, url, headers, timeout):
        self.seen.append((url, headers))
        a = self.answers.pop(0)
        if isinstance(a, Exception):
            raise a
        return feeds.Response(*a)


def session(*answers):
    t, waits = Script(*answers), []
    return feeds.HttpSession({"A": "1"}, transport=t, sleep=waits.append), t, waits


def test_http_retries():
    s, t, waits = session((503,), TimeoutError(), (200, b"ok"))
    assert s.get("http://x/a?b=1", {"c": "d e", "n": None}, {"B": "2"}).content == b"ok"
    assert waits == [0.5, 1.0] and t.seen[0] == ("http://x/a?b=1&c=d+e", {"A": "1", "B": "2"})
    assert session((404,))[0].get("http://x").status == 404
    assert session(*[(500,)] * 4)[0].get("http://x").status == 500
    with pytest.raises(urllib.error.URLError):
        session(*[urllib.error.URLError("x")] * 4)[0].get("http://x")
    with pytest.raises(RuntimeError, match="HTTP 500: bad"):
        feeds.Response(500, b"bad").check()


def test_download_falls_back_on_the_pages_referer():
    s, t, _ = session((403,), (200, b"img"))
    a = feeds.JsonFeedAdapter("http://x", referer="http://main", session=s)
    page = feeds.Page("s", "m", "m/1", 1, "http://img", metadata={"headers": {"Referer": "http://own"}})
    assert a.download(page) == b"img" and t.seen[1][1]["Referer"] == "http://own"
    with pytest.raises(RuntimeError):
        feeds.JsonFeedAdapter("http://x", referer="http://own", session=session((403,))[0]).download(page)


def test_feed_adapter():
    latest, info = json.dumps([{"id": "m", "title": "T"}, {"id": " "}]).encode(), json.dumps({"id": "m", "chapters": [{"id": "m/2"}, {"id": "m/1"}]}).encode()
    a = feeds.JsonFeedAdapter("http://x/", session=session((200, latest), (200, info))[0])
    assert a.list_chapters("0") == ([{"series_id": "m", "chapter_id": "m/2", "title": "T", "last_update": None}], "2")
    assert feeds.JsonFeedAdapter("http://x", session=session((200, b"[]"))[0]).list_chapters() == ([], None)
    with pytest.raises(ValueError):
        feeds.cursor_page("x")


def test_landed_feeds(spark):
    info = json.dumps({"id": " m ", "title": "T", "chapters": [{"id": "m/3"}, {"id": ""}, {"id": "m/1", "isNew": True}]})
    df = spark.createDataFrame([(info,), ('{"chapters": []}',), (None,)], "payload string")
    assert [(r["series_id"], r["chapter_id"], r["is_new"]) for r in feeds.info_chapters(df).orderBy("position").collect()] == [("m", "m/3", False), ("m", "m/1", True)]
    assert feeds.info_chapters(df, limit=2).count() == 1 and feeds.info_chapters(df, limit=0).count() == 0
    pages = spark.createDataFrame([("m/1", json.dumps({"pages": [{"page": 2, "img": "b"}, {"img": "a"}], "next": "m/2"}))], "chapter_id string, payload string")
    assert [(r["series_id"], r["page_index"], r["image_ref"], r["next_chapter"]) for r in feeds.read_pages(pages).orderBy("page_index").collect()] == [("m", 0, "a", "m/2"), ("m", 2, "b", "m/2")]
    assert [r["id"] for r in feeds.latest_items(spark.createDataFrame([('[{"id": "x"}, {"id": ""}, {}]',)], "payload string")).collect()] == ["x"]
    got = spark.createDataFrame([(None,), ("0",), ("7",)], "c string").select(feeds.cursor_column(F.col("c")).alias("n")).collect()
    assert [r["n"] for r in got] == [1, 1, 7]


class Shelf(feeds.ChapterAdapter):
    def list_chapters(self, cursor=None):
        return [], None

    def chapter_pages(self, chapter_id):
        if chapter_id == "gone":
            raise RuntimeError("no such chapter")
        return [feeds.Page("src", "s", chapter_id, i, f"p{i}") for i in (2, 1)]

    def download(self, page):
        if page.chapter_id == "half" and page.page_index == 2:
            raise TimeoutError("slow")
        return b"x"


def test_chapter_source(spark):
    spark.dataSource.register(feeds.ChapterSource)
    rows = spark.read.format("chapters").option("adapter", "tests.test_sources:Shelf").option("chapters", json.dumps(["full", "half", "gone"])).load()
    got = {r["chapter_id"]: (r["status"], r["pages"], r["page_errors"], r["first_page"]) for r in feeds.chapter_report(rows).collect()}
    assert got == {"full": ("ok", 2, 0, 1), "half": ("partial", 1, 1, 1), "gone": ("failed", 0, 1, None)}
    assert sorted(r["error_stage"] for r in rows.where("error is not null").collect()) == ["download_page", "list_pages"]
    with pytest.raises(Exception, match="no such chapter"):
        spark.read.format("chapters").option("adapter", "tests.test_sources:Shelf").option("chapters", '["gone"]').option("failfast", "true").load().collect()


def test_prediction_files_by_suffix(spark, tmp_path):
    one = {"asset_id": "a", "transcript": "t", "polygon": [[0, 0], [1, 0], [1, 1]]}
    folder = tmp_path / "preds"
    folder.mkdir()
    (folder / "a.jsonl").write_text("\n".join([json.dumps({**one, "asset_id": f"a{k}"}) for k in range(3)] + ["", json.dumps({"predictions": [{**one, "asset_id": "w"}]})]))
    (folder / "b.json").write_text(json.dumps([{**one, "asset_id": "b"}], indent=1))
    (folder / "_SUCCESS").write_text("")
    assert sorted(r["asset_id"] for r in files.read_predictions(spark, str(folder)).collect()) == ["a0", "a1", "a2", "b", "w"]
    assert files.read_predictions(spark, str(folder / "a.*")).count() == 4
    with pytest.raises(FileNotFoundError):
        files.read_predictions(spark, str(folder / "none*"))


def test_streamed_catalog_equals_batch_and_survives_replay(spark, tmp_path):
    from pagemill.streaming.ingest import CatalogSink, ingest_available, page_stream
    from tests.test_operators import asset, assets

    src = str(tmp_path / "in")
    sink = CatalogSink(spark, str(tmp_path / "catalog"), PAGE_ASSET)
    with pytest.raises(FileNotFoundError):
        sink.latest()
    fed = [[asset("a", 1, k + 1, width=k, sha256=f"S{k}"), asset(f"x{k}", 2, 10 + k, sha256="s0"), asset(f"n{k}", 3, 20 + k, sha256=None)] for k in range(3)]
    for rows in fed:
        assets(spark, *rows).write.mode("append").parquet(src)
        got = ingest_available(page_stream(spark, src, PAGE_ASSET), sink, str(tmp_path / "cp"))
    rows = lambda df: sorted((r["asset_id"], r["ord"], r["canonical_ord"], r["canonical"], r["duplicate"]) for r in df.collect())
    want = [("a", 3, 3, None, False), *[(f"n{k}", 20 + k, 20 + k, None, False) for k in range(3)], *[(f"x{k}", 10 + k, 1, "a", True) for k in range(3)]]
    assert rows(got) == want
    sink.write(assets(spark, *fed[2]), 2)  # the last batch again, as after a failure
    assert rows(sink.latest()) == want and sink.versions() == [1, 2]
    # a batch writes the buckets that it touches, and what no state names any more is gone
    parts = [p for p in (tmp_path / "catalog" / "catalog").rglob("bucket=*")]
    assert 0 < len([p for p in parts if p.parent.name == "batch=2"]) <= 3 and len(parts) <= 9


class Feed:
    """An HTTP session with two pages of a latest feed and two series."""

    def get(self, url, params=None, headers=None):
        series = {"one": [{"id": "one/2", "title": "b", "isNew": True}, {"id": " "}, {"id": "one/1"}], "two": [{"id": "two/9"}]}
        body = {"latest": {1: [{"id": "one"}, {"id": ""}], 2: [{"id": "two"}, {"id": "one"}]}.get(params.get("page"), [])} if url.endswith("latest") else {"info": {"id": params["id"], "chapters": series[params["id"]]}}
        answer = type("R", (), {"status": 200, "json": lambda self: next(iter(body.values()))})()
        answer.check = lambda: answer
        return answer


def test_chapters_of_series_and_of_the_latest_feed():
    adapter = feeds.JsonFeedAdapter("http://feed", session=Feed())
    assert [(c["chapter_id"], c["is_new"]) for c in adapter.series_chapters("one")] == [("one/2", True), ("one/1", False)]
    assert feeds.chosen_chapters(adapter, ["two", "one"]) == ["two/9", "one/2", "one/1"] and feeds.chosen_chapters(adapter, ["two", "one"], most=2) == ["two/9", "one/2"]
    assert feeds.chosen_chapters(adapter) == ["one/2"] and feeds.chosen_chapters(adapter, pages=9) == ["one/2", "two/9"]
    with pytest.raises(NotImplementedError):
        Shelf().series_chapters("one")
