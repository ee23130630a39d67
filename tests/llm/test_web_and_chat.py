import gzip
import hashlib
import io
import json
import random
import re
import time
from collections import Counter
from html.parser import HTMLParser

import pytest
from pyspark.sql.datasource import EqualTo

from cohortmark.llm import chat, main_text, warc

PAGES = [(1, "http://a/1", "<p>" + "x" * 1200), (2, "http://a/2", "<p>" + "x" * 1200), (3, "u\r\nv", "<p>" + "x" * 1200), (4, None, None), (5, "http://b/5", ""), (6, "http://b/6", "short é"), (7, "http://b/7", "short é"), (8, "http://b/8", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n" * 40)]


def pages(spark, rows=PAGES):
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS digest", "1 AS bytes", "2 AS first_id")


def test_warc_round_trip(spark):
    got = {r.page_id: r for r in warc.round_trip(pages(spark)).collect()}
    assert len(got) == len(PAGES)
    for i, _, h in PAGES:
        raw = (h or "").encode()
        assert (got[i].payload_bytes, got[i].payload_digest) == (len(raw), hashlib.sha1(raw).hexdigest())
    assert {i: (r.record_type, r.refers_to) for i, r in got.items() if r.record_type != "response"} == {1: ("revisit", 3), 2: ("revisit", 3)}
    assert warc.round_trip(pages(spark).limit(0)).count() == 0


def test_warc_reader_filters_and_payloads(spark, tmp_path):
    path = f"file:{tmp_path}/w"
    warc.write(pages(spark).coalesce(2), path)
    df = warc.read(spark, path, "bytes")
    rows = df.where("record_type = 'response' and target_uri like 'http://b/%'").select("record_id", "payload").collect()
    assert {r.record_id: bytes(r.payload) for r in rows} == {f"<urn:page:{i}>": (h or "").encode() for i, u, h in PAGES if i >= 5}
    skip = warc.read(spark, path, "skip").where("record_type in ('revisit')").collect()
    assert {r.record_id for r in skip} == {"<urn:page:1>", "<urn:page:2>"} and all(r.payload is None and r.payload_bytes == 1203 for r in skip)
    whole = b"".join(p.read_bytes() for p in sorted(tmp_path.glob("w/part-*")))
    (tmp_path / "z").mkdir()
    (tmp_path / "z/all.warc.gz").write_bytes(gzip.compress(whole[:400]) + gzip.compress(whole[400:]))
    assert warc.read(spark, str(tmp_path / "z")).count() == len(PAGES)
    reader = warc.WarcReader({"path": path, "splitBytes": "1"})
    assert len(reader.partitions()) == len(list(tmp_path.glob("w/part-*")))


def test_only_wanted_payloads_are_read(spark, tmp_path, monkeypatch):
    warc.write(pages(spark).coalesce(1), f"file:{tmp_path}/w")
    reader = warc.WarcReader({"path": f"{tmp_path}/w", "payload": "digest"})
    assert list(reader.pushFilters([EqualTo(("record_type",), "revisit")])) == []

    class Counting(io.BytesIO):
        taken = 0

        def read(self, n=-1):
            Counting.taken += n
            return super().read(n)

    raw = b"".join(p.read_bytes() for p in tmp_path.glob("w/part-*"))
    got = list(reader.records(Counting(raw), "x"))
    assert len(got) == 2 and Counting.taken == 0  # revisits hold no block; all others are passed by
    monkeypatch.setattr(warc, "FEW_REPEATED", 0)
    again = {r.value for r in warc.records(pages(spark)).collect()}
    monkeypatch.undo()
    assert again == {r.value for r in warc.records(pages(spark)).collect()}


def test_main_text_on_generated_pages_and_hard_html(spark):
    rng = random.Random(12)
    words = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna".split()
    say = lambda a, b: " ".join(rng.choice(words) for _ in range(rng.randint(a, b))).capitalize() + "."
    rows, want = [], {}
    for i in range(60):
        body = [say(3, 8)] + [say(15, 60) for _ in range(rng.randint(3, 9))]
        html = f"<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var t='</p>';</script></head><body><nav><ul>{''.join(f'<li><a href=/{k}>{rng.choice(words)}</a></li>' for k in range(6))}</ul></nav><!-- x --><div class='ad'>{say(4, 9)}</div><article><h1>{body[0]}</h1>{''.join(f'<p>{b} &amp;  &eacute;</p>' for b in body[1:])}</article><footer>&copy; {say(3, 6)}</footer></body></html>"
        rows.append((i, f"u{i}", html))
        want[i] = "\n".join([body[0]] + [f"{b} & é" for b in body[1:]])
    hard = [(100, None, None), (101, "u", ""), (102, "u", "just words"), (103, "u", "<"), (104, "u", "<p"), (105, "u", "<div><b>a</div></p></b>" * 50), (106, "u", "<script>never closed"), (107, "u", "<div>" * 3000 + "deep"), (0, "u0", rows[0][2])]
    got = main_text.main_text(pages(spark, rows + hard)).collect()
    assert len(got) == len(rows) + len(hard)
    by_id = {r.page_id: r for r in got}
    assert sum(by_id[i].text == t for i, t in want.items()) >= 57
    assert by_id[100].text == by_id[101].text == by_id[106].text == "" and by_id[102].text == "just words"
    assert all(r.n_chars == len(r.text) for r in got)
    assert main_text.main_text(pages(spark).limit(0)).count() == 0


def test_main_text_held_out_layouts():
    rng, phrases = random.Random(3), ["Sign up now", "Read more here", "All rights reserved", "Top stories of the week are here", "We use cookies on this site"]
    words = [f"w{i}" for i in range(300)]
    own = lambda: [" ".join(rng.choice(words) for _ in range(rng.randint(8, 60))) + "." for _ in range(rng.randint(2, 12))]
    made = [main_text.Page(main_text.layout(own(), phrases, rng), labelled=True) for _ in range(260)]
    x, y = [], []
    for p in made[:200]:
        t, f = main_text.node_truth(p), p.features()
        use = [i for i, v in enumerate(t) if v is not None]
        x.append(f[use])
        y += [t[i] for i in use]
    import numpy as np

    m = main_text.Boosted(np.concatenate(x), np.array(y, float), trees=30)
    right = wrong = 0
    for p in made[200:]:
        t, kept = main_text.node_truth(p), p.decode(m.odds(p.features()))
        want = [text for node, text, _ in p.pieces if t[node] == 1]
        right += kept == want
        wrong += kept != want
    assert right >= 0.8 * (right + wrong)


CONVERSATIONS = [(0, 0, "user", "hi"), (0, 1, "assistant", "a\\b ### c </turn> d"), (1, 0, "user", "q"), (1, 1, "assistant", None), (2, 1, "assistant", "late"), (2, 0, "system", "first"), (3, 0, None, "no role"), (4, 0, "user", "x"), (4, 0, "user", "x"), (5, 0, "a:b", "\\"), (6, 0, "gpt", "odd role"), (7, 0, "User", ""), (8, None, "user", "null turn"), (9, 0, "assistant", "y" * 30000)]


def test_chat_round_trip(spark):
    df = spark.createDataFrame(CONVERSATIONS, "conv_id long, turn long, role string, text string").selectExpr("*", "'x' AS record")
    got = {r.conv_id: r for r in chat.digests(df).collect()}
    want = {}
    for c, t, r, x in [*CONVERSATIONS, *chat.ESCAPED]:
        want.setdefault(c, []).append((-1 if t is None else t, r or "", x or ""))
    assert set(got) == set(want)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for c, turns in want.items():
        turns.sort()
        loss = "".join(x for _, r, x in turns if r == "assistant")
        assert (got[c].n_turns, got[c].turns_sha256) == (len(turns), sha("".join(f"{r}\n{x}\n" for _, r, x in turns)))
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), sha(loss))
        assert got[c].layout
    assert {r.conv_id for r in chat.digests(df.limit(0)).collect()} == {-7}


def test_fingerprints_choose_layouts(spark):
    records = [
        (1, json.dumps({"response": "r", "prompt": "p"}), "prompt"), (2, json.dumps({"instruction": "i", "input": "n", "output": "o"}), "instruction_input"), (3, json.dumps({"conversations": [{"from": "human", "value": "v"}, {"value": "w", "from": "gpt"}]}), "sharegpt"),
        (4, json.dumps({"data": {"turns": [{"speaker": {"name": "User"}, "utterance": "u"}]}}), "chat_nested"), (5, json.dumps({"messages": []}), "messages"), (6, json.dumps({"other": 1}), None), (7, "not json", None), (8, None, None), (9, json.dumps({"system_prompt": "s", "question": "q", "response": "r"}), "question"),
    ]
    got = {r.conv_id: r for r in chat.chat(spark.createDataFrame([x[:2] for x in records], "conv_id long, record string")).collect()}
    assert {i: got[i].layout for i in got} == {i: name for i, _, name in records}
    assert chat.parsed(got[2].formatted) == [("user", "i\n\nn"), ("assistant", "o")]
    assert chat.parsed(got[3].formatted) == [("user", "v"), ("assistant", "w")] and chat.parsed(got[9].formatted)[0] == ("system", "s")


def test_template_is_reversible():
    rng = random.Random(5)
    bits = ["\\", "###", "#", "</turn>", "<", "/turn>", "\n", ": ", "### Assistant: ", "x", "é", ":"]
    for _ in range(3000):
        turns = [("".join(rng.choice(bits) for _ in range(rng.randint(0, 4))), "".join(rng.choice(bits) for _ in range(rng.randint(0, 8)))) for _ in range(rng.randint(0, 4))]
        assert chat.parsed(chat.formatted(turns)[0]) == turns


def test_odd_records_are_unknown_layouts(spark):
    deep = "[" * 100_000
    rows = [
        (1, '{"prompt": 5, "response": "x"}'), (2, '{"prompt": null, "response": "x"}'), (3, '{"prompt": ["a"], "response": "x"}'), (4, deep), (5, '{"a":' * 5000), (6, "not json"), (7, None),
        (8, '{"messages": [{"role": "user", "content": {"a": 1}}]}'), (9, '{"messages": [{"role": "user", "content": "a"}, {"role": "user", "content": true}]}'), (10, '{"messages": []}'),
        (11, '{"prompt": "\\ud83d", "response": "\\ud83d\\ude00"}'), (12, '{"prompt": {}, "response": "x"}'),
    ]
    got = {r.conv_id: r for r in chat.chat(spark.createDataFrame(rows, "conv_id long, record string")).collect()}
    assert {i for i, r in got.items() if r.layout} == {2, 10, 11}
    assert got[11].formatted == "### user: �</turn>\n### assistant: \U0001f600</turn>\n"
    assert got[1].fingerprint != got[2].fingerprint and got[2].formatted.startswith("### user: </turn>")


class ArticleText(HTMLParser):
    """What stands in <article>, without asides, forms, scripts and what a class names an advert or comments: the truth of a given page."""

    def __init__(self, page):
        super().__init__()
        self.inside, self.out, self.words = 0, [], []
        self.feed(page)

    def handle_starttag(self, tag, attrs):
        names = dict(attrs).get("class") or ""
        if tag in ("br", "img", "hr", "input", "meta", "link"):
            return
        bad = tag in ("aside", "nav", "form", "script", "style", "footer", "header") or re.search(r"\b(ad|ads|comment|comments|promo|notice|cookie)\b", names)
        self.out.append((tag, bool(bad)))
        self.inside += tag == "article"

    def handle_endtag(self, tag):
        while self.out:
            last, _ = self.out.pop()
            self.inside -= last == "article"
            if last == tag:
                return

    def handle_data(self, data):
        if self.inside and not any(bad for _, bad in self.out):
            self.words += data.split()


def test_main_text_of_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: r.text.split() for r in main_text.main_text(pages).collect()}
    found = wanted = right = 0
    for r in pages.collect():
        if (r.html or "").count("<article") == 1 and (truth := ArticleText(r.html).words):
            both = sum((Counter(truth) & Counter(got[r.page_id])).values())
            found, wanted, right = found + len(got[r.page_id]), wanted + len(truth), right + both
    assert wanted > 10_000 and right >= 0.97 * wanted and right >= 0.97 * found


PLAIN = """<html><body><div id="top"><a href=/>Home</a> <a href=/a>News</a> <a href=/b>Sport</a></div>
<div class="c1"><h1>Harvest begins early</h1><div><p>The first fields were cut on Monday, two weeks before the usual date, farmers in the valley said.</p>
<p>Dry weather in spring &amp; a warm June are the reason, they think. Prices may fall, but nobody is sure yet.</p></div></div>
<div class="sidebar"><h3>Most read</h3><ul><li><a href=/1>Ten tips</a></li><li><a href=/2>Quiz</a></li></ul></div>
<div id="comments"><p>Great article, thanks!</p><p>I do not agree at all with this.</p></div><div class="footer">Copyright 2020 The Valley Post</div></body></html>"""


def test_pages_cannot_pose_as_training_layouts(spark):
    odd = [(1, "u", PLAIN), (2, "u", '<div data-truth="x"><p>text here</p></div>'), (3, "u", '<p data-truth="1">more text here</p>'), (4, None, None), (5, "u", "<div>" * 60_000 + "deep"), (6, "u", '<a b="' * 100_000), (7, "u", "<!" * 300_000), (8, "u", "<![CDATA[>" * 50_000), (9, "u", "<script>" + "</script" * 80_000)]
    rows = [(-i, u, h) for i, u, h in odd]
    given = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "url", "html")
    pages, began = given.union(spark.createDataFrame(rows, "page_id long, url string, html string")), time.time()
    got = {-r.page_id: r for r in main_text.main_text(pages).where("page_id < 0").collect()}
    assert len(got) == len(rows) and time.time() - began < 120
    assert got[4].text == "" and got[4].n_chars == 0
    assert "two weeks before the usual date" in got[1].text and "spring & a warm June" in got[1].text
    assert not any(x in got[1].text for x in ("Quiz", "Copyright", "Sport"))


def test_training_reads_long_pages_too(spark):
    long = [(i, "u", f"<article><p>{'words of a long page ' * 4000}</p></article><footer>end {i}</footer>") for i in range(3)]
    model = main_text.train(spark.createDataFrame(long, "page_id long, url string, html string"))
    assert model.trees


@pytest.mark.parametrize("zipped", [False, True])
@pytest.mark.parametrize("payload", ["skip", "bytes"])
def test_a_cut_record_raises_in_every_mode(spark, tmp_path, payload, zipped):
    record = lambda i, body: f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{i}>\r\nContent-Length: {len(body)}\r\n\r\n{body}\r\n\r\n".encode()
    whole = record(1, "a" * 500) + record(2, "b" * 500)
    pack = gzip.compress if zipped else bytes
    name = "x.warc.gz" if zipped else "x.warc"
    (tmp_path / "good").mkdir()
    (tmp_path / "cut").mkdir()
    (tmp_path / "good" / name).write_bytes(pack(whole))
    (tmp_path / "cut" / name).write_bytes(pack(whole[:-300]))
    assert warc.read(spark, str(tmp_path / "good"), payload).count() == 2
    for rows in (warc.read(spark, str(tmp_path / "cut"), payload), warc.read(spark, str(tmp_path / "cut"), payload).where("record_type = 'request'")):
        with pytest.raises(Exception, match="cut record"):
            rows.count()
