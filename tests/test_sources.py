import json

from buzzmill.sources.tables import read_records, read_rss


def test_rss_items(spark, tmp_path):
    item = "<item><title>{}</title><description>&lt;b&gt;A&lt;/b&gt;  film</description><link>u</link><pubDate>{}</pubDate></item>"
    body = item.format("One", "Tue, 02 Jan 2024 03:04:05 GMT") + item.format("Two", "soon")
    (tmp_path / "feed.xml").write_text(f"<rss><channel>{body}</channel></rss>")
    rows = {r["title"]: r for r in read_rss(spark, str(tmp_path)).collect()}
    assert rows["One"]["post_text"] == "A film" and len(rows["One"]["post_id"]) == 24
    assert str(rows["One"]["published_at"]) == "2024-01-02 03:04:05"
    assert rows["Two"]["published_at"] is None and rows["Two"]["post_id"] != rows["One"]["post_id"]


def test_records_of_any_shape(spark, tmp_path):
    """Raw posts hold comments as {data: [...]}; only what is not JSON is left out."""
    reply = {"id": "r", "message": "re", "comments": {"data": [{"id": "rr", "message": "deep"}]}}
    raw = {"id": "1", "message": "post", "comments": {"data": [{"id": "a", "message": "one", "comments": {"data": [reply]}}, {"id": "b", "message": 2}]}}
    flat = {"post_id": "2", "post_text": {"de": "x"}, "comments": [{"external_id": "c", "text": "t", "parent_comment_id": "p"}, None]}
    others = [{"post_id": "3", "comments": 5, "data": {"k": 1}}, {"post_id": "4", "comments": {"data": None}}, [{"post_id": "5"}, "x", None]]
    (tmp_path / "in.jsonl").write_text("\n".join([*map(json.dumps, [raw, flat, *others, {"items": [{"post_id": "6"}, 7]}, "s", 3]), "", "{bad"]))
    got = {r["post_id"]: r for r in read_records(spark, str(tmp_path), lines=True).collect()}
    assert sorted(got) == ["1", "2", "3", "4", "5", "6"]
    assert got["1"]["post_text"] == "post" and json.loads(got["2"]["post_text"]) == {"de": "x"}
    assert [(c["external_id"], c["text"], c["parent_comment_id"]) for c in got["1"]["comments"]] == [("a", "one", None), ("r", "re", "a"), ("rr", "deep", "r"), ("b", "2", None)]
    assert [(c["external_id"], c["text"], c["parent_comment_id"]) for c in got["2"]["comments"]] == [("c", "t", "p")]
    assert got["3"]["comments"] is None and got["4"]["comments"] == []


def test_files_with_odd_elements(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"post_id": "1"},\n "x", null, {"items": [], "data": [{"post_id": "2", "comments": {"data": [{"id": "c"}]}}]}]')
    (tmp_path / "b.json").write_text('{"items": []}')
    (tmp_path / "c.json").write_text('[{"post_id": "9"}, {"post')
    got = {r["post_id"]: r["comments"] for r in read_records(spark, str(tmp_path)).collect()}
    assert sorted(got) == ["1", "2"] and got["2"][0]["external_id"] == "c"
