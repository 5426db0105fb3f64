from __future__ import annotations

import pytest

from indexday.llm.warc import canonical_url, resolve

SCHEMA = "record_id long, url string, captured_at long, kind string, status int, headers map<string,string>, body string, outcome int"


@pytest.mark.parametrize(
    ("url", "want"),
    [
        ("HTTP://user@WWW.Example.com:80/a/b/?utm_source=x&b=2&a=1#top", "example.com/a/b?a=1&b=2"),
        ("https://example.com:443", "example.com"),
        ("https://example.com:8080/?ref=1", "example.com:8080"),
        ("example.com/a?ref", "example.com/a"),
        ("", None),
        (None, None),
    ],
)
def test_canonical_url(frame, url, want):
    assert frame([(url,)], "u string").select(canonical_url("u")).first()[0] == want


def records():
    etag = lambda x: {"ETag": x}
    return [
        (1, "http://a.com/x", 10, "response", 200, {"ETag": '"1"', "Content-Length": "3", "Age": "1"}, "old"),
        (2, "http://a.com/x", 20, "response", 200, {"ETag": '"2"', "Content-Type": "t"}, "new"),
        (3, "http://a.com/x", 15, "revisit", 304, {"etag": 'W/"1"', "age": "9", "content-length": "0"}, None),
        (4, "https://www.a.com/x#y", 25, "revisit", 304, etag('"1"'), None),
        (5, "http://a.com/x", 20, "revisit", 304, etag('"1"'), None),
        (6, "http://a.com/x", 5, "revisit", 304, etag('"1"'), None),
        (7, "http://a.com/x", 30, "revisit", 304, {"age": "1"}, None),
        (8, "http://a.com/x", 22, "response", 404, etag('"2"'), "gone"),
        (9, "http://a.com/x", 30, "revisit", 304, etag('"2"'), None),
        (9, "http://a.com/x", 30, "revisit", 304, etag('"2"'), None),
        (10, None, 30, "revisit", 304, etag('"2"'), None),
        (11, "http://a.com/x", None, "revisit", 304, etag('"2"'), None),
        (12, "http://b.com", 1, "response", 200, {"last-modified": "d"}, "b" * 300_000),
        (13, "http://b.com/", 2, "revisit", 304, {"Last-Modified": "d", "Date": "now"}, None),
        (14, "http://b.com/", 2, "revisit", 304, None, None),
        (15, "http://a.com/x", 20, "response", 200, {"ETag": '"3"'}, "tie"),
    ]


def test_resolution(frame):
    rows = records()
    rows = [r for r in rows if r[0] != 15]
    found = resolve(frame([(*r, 0) for r in rows], SCHEMA).repartition(4)).collect()
    by = {r.record_id: r for r in found}
    assert len(found) == 11
    assert {i: (r.outcome, r.refers_to) for i, r in by.items()} == {
        3: ("resolved", 1), 4: ("changed", 2), 5: ("resolved", 1), 6: ("no_response", None), 7: ("no_validator", 2),
        9: ("resolved", 2), 10: ("no_response", None), 11: ("no_response", None), 13: ("resolved", 12), 14: ("no_validator", 12),
    }
    assert by[3].headers == {"etag": 'W/"1"', "age": "9", "content-length": "3"} and by[3].body == "old"
    assert by[9].headers == {"etag": '"2"', "content-type": "t"}
    assert len(by[13].body) == 300_000 and by[13].headers == {"last-modified": "d", "date": "now"}
    assert by[4].headers is None and by[4].body is None


def test_of_one_moment_the_largest_id_is_latest(frame):
    found = {r.record_id: r for r in resolve(frame([(*r, 0) for r in records()], SCHEMA)).collect()}
    assert (found[9].outcome, found[9].refers_to) == ("changed", 15)


def test_hot_url_crosses_parts(frame):
    rows = [(i, "http://hot/", i, "response" if i % 100 == 0 else "revisit", 200 if i % 100 == 0 else 304, {"etag": '"1"'}, "b", 0)
            for i in range(1000)]
    found = resolve(frame(rows, SCHEMA)).collect()
    assert {(r.record_id, r.refers_to) for r in found} == {(i, i // 100 * 100) for i in range(1000) if i % 100}


def test_empty(frame):
    assert resolve(frame([], SCHEMA)).collect() == []
