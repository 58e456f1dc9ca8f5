"""Unsafe header values, broken archives, and many nested rules."""

import gzip
import random

import pytest

from tenderlens.llm import url_rules, warc, warc_format


def test_line_breaks_in_urls_write_no_fields(spark):
    urls = ["http://a\r\nWARC-Type: revisit", "http://b\r\n\r\nx", "http://c\nWARC-Refers-To: <urn:page:1>", "\x00\x7f"]
    pages = spark.createDataFrame([(i, u, f"<p>{i}</p>") for i, u in enumerate(urls)], "page_id int, url string, html string")
    got = {r["page_id"]: r for r in warc.round_trip(pages).collect()}
    assert sorted(got) == [0, 1, 2, 3]
    assert {(r["record_type"], r["refers_to"], r["payload_bytes"]) for r in got.values()} == {("response", None, 8)}


def test_a_field_keeps_what_it_was():
    _, fields, _ = warc_format.read_headers(warc_format.headers({"A": "x\r\ny", "B": "ü %"}, "WARC/1.1"), 0)
    assert fields == {"a": "x%0D%0Ay", "b": "ü %"}


def _segments() -> list[bytes]:
    made = warc_format.written("<urn:page:7/0-1>", "http://a/", bytes(range(256)) * 40, None, 1000, 3000)
    return [record + warc_format.END for record in made]


def _payloads(spark, folder, records: list[bytes]) -> list[bytes]:
    with gzip.open(folder / "a.gz", "wb") as file:
        file.write(b"".join(records))
    whole = warc.read_archives(spark, str(folder)).collect()
    return [warc_format.http_payload(bytes(r["block"]))[1] for r in whole]


def test_segments_in_any_order_are_put_together(spark, tmp_path):
    segments = _segments()
    assert len(segments) == 4
    assert _payloads(spark, tmp_path, segments[::-1]) == [bytes(range(256)) * 40]


@pytest.mark.parametrize("change", ["first", "middle", "repeated", "short"])
def test_lost_repeated_and_short_segments_are_errors(spark, tmp_path, change):
    segments = _segments()
    if change == "first":
        del segments[0]
    elif change == "middle":
        del segments[1]
    elif change == "repeated":
        segments.append(segments[2])
    else:
        segments[2] = segments[2][:-20] + warc_format.END
    with pytest.raises(Exception, match="segments|cut off"):
        _payloads(spark, tmp_path, segments)


def test_many_nested_rules_against_brute_force(spark):
    draw = random.Random(3)
    labels, steps = ["a", "b", "cc", "a-b"], ["x/", "y/", "xy/", "é/"]
    rules = {}
    while len(rules) < 3000:
        host = ".".join(draw.choice(labels) for _ in range(draw.randint(1, 6)))
        path = "/" + "".join(draw.choice(steps) for _ in range(draw.randint(0, 5)))
        rules[host, path] = draw.choice(["allow", "block"])
    urls = []
    for i in range(2000):
        host = ".".join(draw.choice(labels) for _ in range(draw.randint(1, 9))) if i % 3 else "a.b.cc"
        urls.append((i, f"http://{host}/" + "".join(draw.choice(steps) for _ in range(draw.randint(0, 7)))))

    def fitting(url):
        host, _, path = url.removeprefix("http://").partition("/")
        names = host.split(".")
        ends = [".".join(names[i:]) for i in range(len(names))]
        path = "/" + path
        found = [(len(h + path[:n]), len(h), h + path[:n], rules[h, path[:n]])
                 for h in ends for n in range(len(path) + 1) if (h, path[:n]) in rules]
        return max(found)[2:] if found else (None, "allow")

    table = spark.createDataFrame([(*k, v) for k, v in rules.items()], "host string, path string, verdict string")
    judged = url_rules.judge(spark.createDataFrame(urls, "page_id int, url string"), table)
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in judged.collect()}
    assert got == {i: fitting(url) for i, url in urls}


def test_rules_are_placed_without_a_nested_loop(spark):
    keys = spark.createDataFrame([("a.b.",), ("a.",), ("",)], "key string")
    swept = url_rules.sweep(keys, spark.createDataFrame([("a.",), ("a.b.",), ("a.b.c.",), ("",)], "prefix string"))
    plan = swept._jdf.queryExecution().executedPlan().toString()
    assert "Join" in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    assert {r["key"]: r["open"] for r in swept.collect()} == {"": [""], "a.": ["", "a."], "a.b.": ["", "a.", "a.b."]}
