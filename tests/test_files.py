"""Files, discovery, publication with faults, and streams."""

import http.server
import threading

import pytest
from pyspark.sql import functions as F

from shelfmark.functions import urls
from shelfmark.plans import publish
from shelfmark.sources import discovery, files, images, payload
from shelfmark.streaming import updates


def test_csv_with_mark(spark, tmp_path):
    p = tmp_path / "a.csv"
    p.write_text("store_id,product_name,price_ex_tax_yen,source_type\ns,りんご,108.9,a\ns,,x,b\n", encoding="utf-8-sig")
    df = files.read_products(spark, str(p))
    assert df.columns[0] == "store_id"
    assert [(r["product_name"], r["price_ex_tax_yen"]) for r in df.collect()] == [("りんご", 108.9), (None, None)]
    assert files.read_of_type(spark, str(p), "b").count() == 1
    files.write_csv(df, str(tmp_path / "out"), ["product_name", "store_id"])
    assert files.read_csv(spark, str(tmp_path / "out")).columns == ["product_name", "store_id"]
    kept = files.read_products(spark, str(p), keep_text=True).collect()
    assert [r["price_ex_tax_yen_text"] for r in kept] == [None, "x"]


def test_one_file_with_mark(spark, tmp_path):
    import csv

    rows = [(1, 'a "b", c', None), (2, "", "二"), (3, " x ", "z")]
    p = str(tmp_path / "out.csv")
    for _ in range(2):  # replaced, not added to
        files.write_csv_file(spark.createDataFrame(rows, "n int, t string, u string").orderBy("n"), p, ["t", "n", "u"])
    raw = open(p, "rb").read()
    assert raw.startswith(b"\xef\xbb\xbft,n,u\r\n")
    with open(p, encoding="utf-8-sig", newline="") as f:
        assert list(csv.DictReader(f)) == [{"t": t, "n": str(n), "u": u or ""} for n, t, u in rows]
    assert [r["t"] for r in files.read_csv(spark, p).collect()][0] == 'a "b", c'
    files.write_csv_file(spark.createDataFrame([], "n int, t string"), p)
    assert open(p, encoding="utf-8-sig").read().strip() == "n,t"


def test_documents(spark, tmp_path):
    import json

    p = str(tmp_path / "m.json")
    files.write_document(spark.createDataFrame([("v", [1, 2], None)], "version string, xs array<int>, `名` string"), p)
    want = {"version": "v", "xs": [1, 2], "名": None}
    assert open(p, encoding="utf8").read() == json.dumps(want, ensure_ascii=False, indent=2) + "\n"
    assert files.read_json(spark, p, "version string, xs array<int>").first().asDict() == {"version": "v", "xs": [1, 2]}
    assert files.read_json(spark, p).count() == 1
    with pytest.raises(ValueError):
        files.write_document(spark.range(2), p)
    files.write_text(spark.createDataFrame([("one line",)], "value string"), str(tmp_path / "t1"), str(tmp_path / "t2"))
    assert open(tmp_path / "t1").read() == open(tmp_path / "t2").read() == "one line\n"
    files.write_json(spark.range(3), str(tmp_path / "lines"))
    assert spark.read.json(str(tmp_path / "lines")).count() == 3


def test_detections(spark, tmp_path):
    found = spark.createDataFrame([("v2", "a.jpg", "h1", ("red", 3), [1, 2]), ("v2", "b.b.jpg", "h2", ("red", 3), None)], "detector_version string, image_filename string, image_sha256 string, profile struct<mode:string,k:int>, result array<int>")
    folder = str(tmp_path / "cache")
    assert files.save_detections(found, folder) == 2 and files.save_detections(found.limit(1), folder) == 1
    assert sorted(p.name for p in (tmp_path / "cache").iterdir() if not p.name.startswith(".")) == ["a.json", "b.b.json"]
    back = files.read_detections(spark, folder, "struct<mode:string,k:int>", "array<int>")
    assert sorted(map(tuple, back.select("image_filename", "result").collect())) == [("a.jpg", [1, 2]), ("b.b.jpg", None)]
    required = spark.createDataFrame([("h1", "v2"), ("h2", "v3"), ("h9", "v2")], "image_sha256 string, detector_version string")
    hit, miss = files.cached(required, back, ["image_sha256", "detector_version"])
    assert [r["image_filename"] for r in hit.collect()] == ["a.jpg"] and miss.count() == 2


def test_words_become_tokens(spark):
    words = spark.createDataFrame([("i", 0, " りんご ", 90.0, 10, 20, 30, 40, 3200), ("i", 1, " ", 90.0, 1, 1, 1, 1, 3200), ("i", 2, "x", -1.0, 1, 1, 1, 1, 3200)], "image_id string, ordinal int, text string, confidence double, left int, top int, width int, height int, page_height int")
    [t] = files.token_rows(words, 1600).collect()
    assert (t["text"], t["x1"], t["y1"], t["x2"], t["y2"], t["scaled_height"]) == ("りんご", 20, 40, 80, 120, 40)


def test_images(spark, tmp_path):
    png = bytes.fromhex("89504E470D0A1A0A0000000D49484452") + (640).to_bytes(4, "big") + (480).to_bytes(4, "big")
    (tmp_path / "a.jpg").write_bytes(png)
    (tmp_path / "b.jpg").write_bytes(b"text")
    got = {r["cache_filename"]: (r["mime_magic"], r["width"], r["height"], r["bytes"]) for r in files.read_images(spark, str(tmp_path)).collect()}
    assert got == {"a.jpg": ("image/png", 640, 480, 24), "b.jpg": (None, None, None, 4)}
    assert files.tree_fingerprint(spark, str(tmp_path), ["a.jpg"], "*.jpg").count() == 1


JPEG = bytes.fromhex("FFD8FFE000104A46494600010100000100010000FFFE0006616263FFFFC2001108") + (480).to_bytes(2, "big") + (640).to_bytes(2, "big") + bytes(8)
WEBP = {
    "lossy": b"RIFF\0\0\0\0WEBPVP8 \0\0\0\0" + b"\0\0\0\x9d\x01\x2a" + (640).to_bytes(2, "little") + (480 | 1 << 14).to_bytes(2, "little"),
    "lossless": b"RIFF\0\0\0\0WEBPVP8L\0\0\0\0\x2f" + (639 | 479 << 14).to_bytes(4, "little"),
    "extended": b"RIFF\0\0\0\0WEBPVP8X\0\0\0\0" + bytes(4) + (639).to_bytes(3, "little") + (479).to_bytes(3, "little"),
}


def test_sizes_from_headers(spark, tmp_path):
    for name, data in {"a.jpg": JPEG, **{f"{k}.jpg": v for k, v in WEBP.items()}}.items():
        assert images.size_of(data) == (640, 480), name
        assert all(images.size_of(data[:n]) in (None, (640, 480)) for n in range(len(data)))
        (tmp_path / name).write_bytes(data)
    got = files.read_images(spark, str(tmp_path)).collect()
    assert len(got) == 4 and all((r["width"], r["height"]) == (640, 480) and r["mime_magic"] for r in got)
    assert images.size_of(b"") is None and images.size_of(b"\xff\xd8\xff\xd9") is None


def test_srcset():
    assert urls.srcset_urls("a_0.jpg 1x, logo.png 2x") == ["a_0.jpg", "logo.png"]
    assert urls.srcset_urls(" , x,y.jpg , z.png, w.png 2x (a, b),v.png") == ["x,y.jpg", "z.png", "w.png", "v.png"]
    assert urls.srcset_urls("") == []


def test_bad_payload_is_an_error(spark):
    schema = spark.createDataFrame([], "a int").schema
    good = payload.to_payload(spark.createDataFrame([(2,), (1,), (None,)], "a int"), {"v": "1"}, schema, ["a"])
    assert good.first()["value"] == 'window.FLYER_DATA={"meta":{"v":"1"},"products":[{"a":null},{"a":1},{"a":2}]};'
    with pytest.raises(Exception, match="not a payload"):
        payload.from_payload(spark.createDataFrame([("var x=1",)], "value string"), schema, "v string").collect()


SOURCES = [
    ("life", "s1", 0, "https://a.example/1", False, '2026年9月11日〜9月14日<img alt="チラシ" src="https://image.tokubai.co.jp/images/bargain_office_leaflets/a.jpg">'),
    ("com", "s2", 0, "https://chirashi-guide.com/2/", False, '2026年9月12日〜9月15日<img alt="チラシ" src="/chirashi-file/2026/09/x_0thum.jpg"><img alt="チラシ" src="/chirashi-file/2026/09/y_0thum.jpg">'),
    ("bel", "s3", 0, "https://a.example/3", True, "nothing here"),
    ("bel", "s3", 1, "https://chirashi-guide.com/3/", True, '<div>09月12日更新</div><img src="/chirashi-file/z_0.jpg"><img src="/chirashi-file/z_1.jpg"><img src="/chirashi-file/z_2.jpg">'),
    ("none", "s4", 0, "https://a.example/4", False, "nothing"),
]


def test_discovery(spark):
    pages = spark.createDataFrame([(i, s, "c", "n", k, u, w, h) for i, s, k, u, w, h in SOURCES], "id string, store_id string, chain string, store_name string, choice int, page_url string, weekly boolean, html string")
    groups = discovery.groups(pages, 2026)
    got = {r["id"]: (r["sale_start"], r["sale_end"], len(r["images"]), r["ok"]) for r in groups.collect()}
    assert got == {"life": ("2026-09-11", "2026-09-14", 1, True), "com": ("2026-09-12", "2026-09-15", 2, True), "bel": ("2026-09-12", "2026-09-18", 2, True), "none": ("", "", 0, False)}
    m = discovery.manifest(groups.filter("ok"), spark.createDataFrame([], "day string")).first()
    assert m["date_buttons"][0] == "2026-09-11" and len(m["date_buttons"]) == 8
    assert discovery.manifest(groups, spark.createDataFrame([("2026-09-13",)], "day string")).first()["date_buttons"] == ["2026-09-13"]


@pytest.fixture
def server():
    png = images_png(640, 480)
    asked = []

    class Quiet(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            asked.append((self.path, self.headers.get("Referer")))
            answers = {"/a": (200, "text/html", b"<p>hi</p>"), "/img": (200, "image/png; q=1", png), "/small": (200, "image/png", images_png(640, 480, 500)), "/thin": (200, "image/png", images_png(640, 20)), "/text": (200, "image/png", b"x" * 20_000)}
            if self.path == "/moved":
                self.send_response(302)
                self.send_header("Location", "/img")
                self.end_headers()
                return
            status, kind, body = answers.get(self.path, (404, "text/html", b"gone"))
            self.send_response(status)
            self.send_header("Content-Type", kind)
            self.send_header("ETag", '"e1"')
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *_):
            pass

    s = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Quiet)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}", asked
    s.shutdown()


def images_png(width, height, size=20_000):
    head = bytes.fromhex("89504E470D0A1A0A0000000D49484452") + width.to_bytes(4, "big") + height.to_bytes(4, "big")
    return head + bytes(size - len(head))


def test_pages_over_http(spark, server):
    base, asked = server
    spark.dataSource.register(discovery.PageSource)
    got = {r["url"][-1]: (r["status"], r["html"], r["error"] is None) for r in spark.read.format("pages").option("urls", f"{base}/a\n{base}/b").load().collect()}
    assert got == {"a": (200, "<p>hi</p>", True), "b": (404, None, False)}
    assert [p for p, _ in asked].count("/b") == 1  # a wrong address is not asked for again


def test_images_over_http(spark, server):
    base, asked = server
    spark.dataSource.register(discovery.ImageSource)
    lines = "\n".join(f"{base}/{p}\thttp://page/" for p in ("img", "moved", "a", "small", "thin", "text", "none"))
    got = spark.read.format("images").option("urls", lines).load().persist()
    errors = {r["source_url"].rsplit("/", 1)[1]: r["error"] for r in got.collect()}
    assert errors["img"] is errors["moved"] is None and "content-type" in errors["a"] and "404" in errors["none"]
    assert "small" in errors["small"] and "small" in errors["thin"] and "magic" in errors["text"]
    assert all(r == "http://page/" for p, r in asked if p != "/img")
    entries = {e["source_url"].rsplit("/", 1)[1]: e for e in discovery.provenance(got).collect()}
    assert entries.keys() == {"img", "moved"} and entries["moved"]["final_url"] == f"{base}/img" and entries["img"]["final_url"] == f"{base}/img"
    e = entries["img"]
    assert (e["bytes"], e["width"], e["height"], e["http_status"], e["content_type_header"], e["etag"], e["referer"]) == (20_000, 640, 480, 200, "image/png", '"e1"', "http://page/")


def test_images_of_groups(spark, server, tmp_path):
    import hashlib

    base, asked = server
    found = spark.createDataFrame([("g", f"{base}/a", [f"{base}/img", f"{base}/moved"], "f"), ("h", "p", [f"{base}/small"], "f"), ("i", "p", [], "f")], "id string, page_url string, images array<string>, fingerprint string")
    got = {r["id"]: r for r in discovery.group_images(found, str(tmp_path / "cache")).collect()}
    sha = hashlib.sha256(images_png(640, 480)).hexdigest()
    assert [tuple(x) for x in got["g"]["local_images"]] == [(0, sha[:20] + ".jpg", sha), (1, sha[:20] + ".jpg", sha)]
    assert got["g"]["fingerprint"] == hashlib.sha256(f"f|{sha}|{sha}".encode()).hexdigest() and got["g"]["error"] is None
    assert got["h"]["error"] == "implausibly small image" and got["h"]["fingerprint"] is None
    assert got["i"]["fingerprint"] == hashlib.sha256(b"f|").hexdigest()
    assert [p.name for p in (tmp_path / "cache").iterdir() if not p.name.startswith(".")] == [sha[:20] + ".jpg"]
    assert ("/img", f"{base}/a") in asked


def test_offline_cache(spark, tmp_path):
    url = "https://e.example/x.jpg"
    name = spark.range(1).select(urls.cache_name(F.lit(url))).first()[0]
    (tmp_path / name).write_bytes(b"image")
    required = spark.createDataFrame([(url,), ("https://e.example/y.jpg",)], "source_url string")
    assert sorted(r["content"] is None for r in files.cached_images(spark, required, str(tmp_path)).collect()) == [False, True]
    assert files.cached_images(spark, required.limit(1), str(tmp_path), offline=True).first()["content"] == b"image"
    with pytest.raises(Exception, match="cache missing"):
        files.cached_images(spark, required, str(tmp_path), offline=True).collect()


def test_publish_and_faults(spark, tmp_path):
    store = publish.Store(spark, f"file://{tmp_path}/store")
    old, new = spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([(2,), (3,)], "a int")
    passes = lambda df: []
    first = store.publish(old, passes)
    for step in ("after_write", "after_gate"):

        def fault(at, step=step):
            if at == step:
                raise RuntimeError(step)

        with pytest.raises(RuntimeError):
            store.publish(new, passes, fault)
        assert store.current_id() == first
    store.fs.create(store.path(f"{store.root}/.lock"), False).close()
    with pytest.raises(publish.Busy):
        store.publish(new, passes)
    # A lock that a crash left behind is taken over once its lease is over.
    late = publish.Store(spark, store.root, lease=-60.0)
    with pytest.raises(publish.GateError):
        late.publish(new, lambda df: ["bad"])
    assert store.current_id() == first and not store.fs.exists(store.path(f"{store.root}/.lock"))
    with pytest.raises(publish.GateError):
        store.publish(new, lambda df: ["bad"])
    assert [r["a"] for r in store.current().collect()] == [1]
    prints = lambda *rows: spark.createDataFrame(rows, "store_id string, fingerprint string")
    assert publish.update(store, prints(("s", "f")), prints(("s", "f")), lambda: new, passes) == "unchanged"
    for odd in (prints(("s", "")), prints(("s", None)), prints(), prints(("s", "f"), ("t", "f"))):
        assert publish.update(store, odd, odd if odd.count() < 2 else prints(("s", "f")), lambda: old, passes) == "published"
    assert publish.update(store, prints(("s", "f")), prints(("s", "g")), lambda: new, passes) == "published"
    assert sorted(r["a"] for r in store.current().collect()) == [2, 3]
    second = store.current_id()
    third = late.publish(old, passes)
    assert sorted(p.name for p in (tmp_path / "store").iterdir() if p.name.startswith("snapshot-")) == sorted([second, third])


def test_streams(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet").orderBy("ts")
    source = str(tmp_path / "in")
    events.repartitionByRange(3, "ts").write.parquet(source)
    seen = []
    windows = updates.windowed_counts(updates.event_stream(spark, source, events.schema), "1 day", late="365 days")
    updates.run_available(windows, str(tmp_path / "c1"), lambda df, _: seen.extend(df.collect()), "update")
    last = {(r["start"], r["event_type"]): r["n"] for r in seen}
    whole = updates.windowed_counts(events.withColumn("ts", F.col("ts").cast("timestamp")), "1 day").collect()
    assert last == {(r["start"], r["event_type"]): r["n"] for r in whole} and sum(last.values()) == events.count()
    sessions = []
    updates.run_available(updates.sessions(updates.event_stream(spark, source, events.schema), late="1 hour"), str(tmp_path / "c2"), lambda df, _: sessions.extend(df.collect()))
    assert sum(r["n"] for r in sessions) > 0


def test_a_quoted_line_break_stays_in_its_row(spark, tmp_path):
    (tmp_path / "x.csv").write_text('source_type,verification_note,product_name\na,"two\nlines ""quoted""",x\nb,plain,y\n', encoding="utf-8")
    got = files.read_of_type(spark, f"{tmp_path}/x.csv", "a").collect()
    assert [tuple(r) for r in got] == [("a", 'two\nlines "quoted"', "x")]
