"""Near-duplicates, decontamination, fingerprints, archives, extraction and the pipeline."""

from __future__ import annotations

import hashlib
import io
import itertools
import random
import re
import struct
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest
import xxhash
import zstandard
from pyspark.sql import functions as F

import corpus_pipeline
from tickweave.llm import decontaminate, extract, fingerprints, neardup, warc
from tests_llm_words import words


# --- near-duplicates --------------------------------------------------------


def plain_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    grams = [" ".join(w)] if len(w) < 3 else [" ".join(w[i : i + 3]) for i in range(len(w) - 2)]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(fps))]


@pytest.mark.parametrize("text", ["", " ", "A", "A b", "Ä B c", "a b c d", "x\x0by\x1cz w", "tab\tnew\nline CAPS caps"])
def test_fingerprint(text):
    assert neardup.fingerprint(text.encode()) == plain_fingerprint(text)


@pytest.mark.parametrize("near", [2, 64])
def test_links_against_all_pairs(spark, monkeypatch, near):
    """Planted balls and chains, with runs of a key longer than the window, so both levels are used."""
    monkeypatch.setattr(neardup, "NEAR", near)
    rng = random.Random(near)
    fps = [rng.getrandbits(64) for _ in range(150)]
    centre = rng.getrandbits(64)
    fps += [centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for _ in range(90)]
    chain = rng.getrandbits(64)
    for step in range(20):
        chain ^= sum(1 << b for b in rng.sample(range(64), 1 + step % 3))
        fps.append(chain)
    block = rng.getrandbits(64)
    fps += [block ^ sum(1 << b for b in rng.sample(range(21), 3)) for _ in range(60)]
    fps = sorted(set(fps))
    df = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long").repartition(3)
    edges = [(x.a, x.b) for x in neardup.links(df).collect()]
    signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
    at = {f: i for i, f in enumerate(signed)}
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((find(at[a]), find(at[b])))
        root[b] = a
    assert [find(i) for i in range(len(fps))] == plain_components(fps)


def test_classes_and_dedup(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = docs.orderBy("doc_id").collect()
    expected = plain_components([plain_fingerprint(x.text) for x in rows])
    got = {x.doc_id: x.component for x in neardup.classes(docs).collect()}
    assert got == {x.doc_id: rows[c].doc_id for x, c in zip(rows, expected, strict=True)}
    assert sorted(x.doc_id for x in neardup.dedup(docs).collect()) == sorted(set(got.values()))


def test_neardup_odd_rows(odd_docs, no_docs, make_docs):
    got = neardup.classes(odd_docs).collect()
    assert len(got) == odd_docs.count()
    assert {x.component for x in got if x.doc_id in (2, 3, 7)} == {2} and {x.component for x in got if x.doc_id in (5, 6)} == {5}
    kept = neardup.dedup(odd_docs)
    ids = [x.doc_id for x in kept.collect()]
    assert kept.columns == odd_docs.columns and len(ids) == len(set(ids)) and {1, 2, 5, None} <= set(ids) and not {3, 6, 7, 8} & set(ids)
    assert neardup.classes(no_docs).count() == 0 and neardup.dedup(no_docs).count() == 0
    bare = make_docs([(None, "same text of four", "a"), (None, "same text of four", "b"), (None, "another text than that", "a")])
    assert neardup.dedup(bare).count() == 2


def test_dedup_with_ids_that_name_several_texts(make_docs):
    a, b, c = (words(random.Random(i), 40) for i in range(3))
    kept = lambda *rows: sorted((x.doc_id, x.text) for x in neardup.dedup(make_docs([(i, t, "s") for i, t in rows]).repartition(3)).collect())
    assert kept((3, a), (5, a), (5, b), (7, c)) == sorted([(3, a), (5, b), (7, c)])
    assert kept((5, a), (5, b), (6, b), (5, b)) == sorted([(5, a), (5, b)])
    near = [f"{a} {a} {a} {a} {a} {x}" for x in ("", " ")]
    assert len({tuple(kept((5, near[k]), (5, near[1 - k]), (8, c))) for k in (0, 1)}) == 1


# --- decontamination --------------------------------------------------------


def plain_distance(pattern, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern):
        new = [i + 1]
        for j, d in enumerate(text):
            new.append(min(row[j] + (c != d), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def test_myers_is_edit_distance():
    rng = random.Random(7)
    for _ in range(150):
        m = rng.randint(1, 90)
        pattern = "".join(rng.choice("abc") for _ in range(m))
        text = "".join(rng.choice("abc") for _ in range(rng.randint(0, 120)))
        item = decontaminate.Item(1, pattern, 0)
        found = decontaminate.myers(item.peq, m, text, m)
        best = plain_distance(pattern, text)
        assert (found[0] if found else m) == best


def edited(rng, text, n):
    out = list(text)
    for _ in range(n):
        k = rng.randrange(len(out))
        kind = rng.randrange(3)
        if kind == 0:
            out[k] = rng.choice("xyzq")
        elif kind == 1:
            del out[k]
        else:
            out.insert(k, rng.choice("xyzq"))
    return "".join(out)


def test_planted_passages(spark, make_docs):
    rng = random.Random(8)
    items = [words(rng, 25) for _ in range(6)]
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(items)] + [(90, None), (91, ""), (92, "tiny item")], "item_id long, text string")
    rows, expected = [], set()
    for k in range(40):
        text = words(rng, 60)
        if k % 4 == 0:
            i = rng.randrange(6)
            budget = int(decontaminate.ERROR_RATE * len(items[i]))
            passage = edited(rng, decontaminate.normal(items[i]), rng.randint(0, budget))
            text = f"{text}\n {passage.upper()}  {words(rng, 30)}"
            expected.add((k, i))
        rows.append((k, text, "s"))
    rows += [(100, "a tiny  ITEM is here", "s"), (101, "a tiny itemised list", "s"), (None, items[0], "s")]
    docs = make_docs(rows)
    found = decontaminate.find(docs, bench).collect()
    assert {(x.doc_id, x.item_id) for x in found} == expected | {(100, 92), (None, 0)}
    texts = {r[0]: decontaminate.normal(r[1]) for r in rows}
    for x in found:
        if x.item_id < 90:
            item = decontaminate.normal(items[x.item_id])
            assert x.distance == plain_distance(item, texts[x.doc_id])
            piece = texts[x.doc_id][x.start : x.end]
            assert plain_distance(item, piece) == x.distance
    kept = decontaminate.clean(docs, bench)
    assert kept.count() == len(rows) - len(expected) - 2 and kept.columns == docs.columns


def test_decontaminate_blocks_and_odd_rows(spark, odd_docs, no_docs, monkeypatch):
    bench = spark.createDataFrame([(1, "one two three"), (2, None)], "item_id long, text string")
    assert sorted(x.doc_id for x in decontaminate.find(odd_docs, bench).collect()) == [1, 8, 8]
    assert decontaminate.find(no_docs, bench).count() == 0 and decontaminate.find(odd_docs, bench.where("false")).count() == 0
    many = spark.createDataFrame([(i, f"one two three number {i} of many") for i in range(20)] + [(50, "one two three")], "item_id long, text string")
    monkeypatch.setattr(decontaminate.Blocks.__init__, "__defaults__", (100,))
    monkeypatch.setattr(decontaminate, "HELD_BYTES", 500)
    assert sorted(x.doc_id for x in decontaminate.find(odd_docs, many).collect()) == [1, 8, 8]
    assert decontaminate.clean(odd_docs, many).count() == odd_docs.count() - 3


def test_a_benchmark_that_tasks_cannot_read_is_an_error(spark, odd_docs, tmp_path):
    import shutil

    bench = spark.createDataFrame([(1, "one two three"), (2, "four five six seven")], "item_id long, text string")
    for damage in ("folder", "file"):
        found = decontaminate.find(odd_docs, bench)
        blocks = decontaminate.Blocks(bench, 0.08)
        folder = Path(decontaminate.store_of(blocks.folder)[1]) / "block=0"
        assert blocks.sizes == {0: 2} and len(next(iter(blocks.matchers())).items) == 2
        blocks.kept = None
        if damage == "folder":
            shutil.rmtree(folder)
        else:
            next(folder.glob("*.parquet")).unlink()
        with pytest.raises(FileNotFoundError):
            next(blocks.matchers())
        assert found.count() == 3  # its own blocks are whole


def test_shared_folders_are_full_addresses(spark):
    from tickweave.llm import common

    assert common.full_address(spark, "/tmp/no-scheme") == "file:/tmp/no-scheme"
    assert common.full_address(spark, "file:///tmp/one") == "file:/tmp/one"
    assert common.store_of(f"{common.own_dir(spark)}/x")[1].endswith("/x")


def test_items_with_a_common_sentence_are_not_all_verified():
    import time

    rng = random.Random(12)
    own = lambda n: " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 9))) for _ in range(n))
    first = own(14) + ". "
    items = [(i, first + own(40)) for i in range(8_000)]
    matcher = decontaminate.Matcher(items)
    clean_text = decontaminate.normal(own(300) + " " + first + own(300))
    began = time.perf_counter()
    assert list(matcher.find(clean_text)) == []
    assert time.perf_counter() - began < 1.0  # a Myers run for each item takes several seconds
    small = decontaminate.Matcher(items[:300])
    for k in range(25):  # and none is lost: edits up to the budget, all items against the plain distance
        text = decontaminate.normal(own(20) + " " + edited(rng, decontaminate.normal(items[k][1]), small.items[k].budget - k % 3) + " " + own(20))
        want = {i.item_id for i in small.items if decontaminate.myers(i.peq, len(i.text), text, i.budget)}
        assert {hit[0] for hit in small.find(text)} == want and k in want


# --- fingerprints -----------------------------------------------------------


def test_syncmers_by_brute_force():
    rng = random.Random(9)
    data = words(rng, 200).encode()
    at, _ = fingerprints.syncmers(data)
    b = np.frombuffer(data, np.uint8).astype(np.uint64)
    codes = np.array([sum(int(x) << 8 * (fingerprints.S - 1 - j) for j, x in enumerate(b[i : i + fingerprints.S])) for i in range(len(b) - fingerprints.S + 1)], np.uint64)
    h = fingerprints._mix(codes)
    w = fingerprints.K - fingerprints.S + 1
    expected = [i for i in range(len(b) - fingerprints.K + 1) if h[i : i + w].min() in (h[i], h[i + w - 1])]
    assert at.tolist() == expected
    # free of context: what a k-mer is doesn't change with what is around it
    cut, hashes = fingerprints.syncmers(data[100:300])
    whole = dict(zip(*(x.tolist() for x in fingerprints.syncmers(data)), strict=True))
    assert {p + 100: x for p, x in zip(cut.tolist(), hashes.tolist(), strict=True)} == {p: x for p, x in whole.items() if 100 <= p <= 300 - fingerprints.K}


@pytest.mark.parametrize("size", [10**9, 2000, 300])
def test_next_document_across_ranges(make_docs, monkeypatch, size):
    rng = random.Random(10)
    texts = [words(rng, rng.randint(0, 60)) + rng.choice(["", "é", "😀"]) for _ in range(90)]
    docs = make_docs([(i * 3, t, "s") for i, t in enumerate(texts)]).repartition(5)
    monkeypatch.setattr(fingerprints, "RANGE_BYTES", size)
    got = {x.doc_id: x for x in fingerprints.fingerprint(docs).collect()}
    assert len(got) == 90
    prints = [got[i * 3].fingerprint for i in range(90)]
    for i, t in enumerate(texts):
        after, half = texts[(i + 1) % 90], len(t) // 2
        x = got[i * 3]
        assert x.n_chars == len(t)
        assert x.edited_sha256 == hashlib.sha256((t[: len(t) - half] + after[:half]).encode()).hexdigest()
        assert x.fingerprint == fingerprints.written_out(fingerprints.sketch(*fingerprints.syncmers(t.encode())))
        assert (x.near_next == 1.0) == (prints[i] == prints[(i + 1) % 90]) and 0 <= x.near_edited <= 1


def test_likeness_is_the_longest_common_order():
    rng = random.Random(12)
    for _ in range(30):
        a, b = (np.zeros((2, fingerprints.BINS), np.int64) for _ in range(2))
        n = rng.randint(0, 8)
        for k in range(n):
            a[:, k], b[:, k] = (rng.choice([7, 9]), rng.randint(0, 9)), (rng.choice([0, 7, 9]), rng.randint(0, 9))
        same = [k for k in range(n) if a[0, k] == b[0, k]]
        most = max(len(c) for r in range(len(same) + 1) for c in itertools.combinations(same, r) if all((a[1, i] < a[1, j]) == (b[1, i] < b[1, j]) and a[1, i] != a[1, j] and b[1, i] != b[1, j] for i, j in itertools.combinations(c, 2)))
        assert fingerprints.likeness(a, b) == (most / n if n else 1.0)


def test_order_tells_texts_apart():
    """The same sentences in another order share all their inner anchors, but not in order."""
    rng = random.Random(13)
    parts = [words(rng, 60) for _ in range(12)]
    sketch = lambda t: fingerprints.sketch(*fingerprints.syncmers(t.encode()))
    whole, put_in, turned = sketch(" ".join(parts)), sketch(" ".join([*parts[:6], words(rng, 20), *parts[6:]])), sketch(" ".join(parts[::-1]))
    assert fingerprints.likeness(whole, whole) == 1.0 and fingerprints.likeness(whole, put_in) > 0.7 > 0.4 > fingerprints.likeness(whole, turned)


def test_fingerprint_odd_rows(odd_docs, no_docs, make_docs):
    rows = fingerprints.fingerprint(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert len({x.fingerprint for x in rows if x.doc_id in (1, 8)}) == 1 and len({x.fingerprint for x in rows if x.doc_id in (5, 6)}) == 1
    assert fingerprints.fingerprint(no_docs).count() == 0
    (alone,) = fingerprints.fingerprint(make_docs([(1, "a text that follows itself, as it is alone", "s")])).collect()
    assert alone.near_next == 1.0
    shared = fingerprints.shared_anchors(odd_docs.where("doc_id = 5"), odd_docs.where("doc_id = 6")).collect()
    assert max(shared, key=lambda x: x.anchors)["shift"] == 0
    assert fingerprints.anchors(no_docs).count() == 0


# --- archives ---------------------------------------------------------------


@pytest.fixture(scope="module")
def pages(spark):
    big = "<p>" + "é" * 800 + "</p>"
    rows = [(1, "http://a/", big), (2, "http://b/", big), (9, None, big), (3, "http://c/", "<p>small</p>"), (4, "http://d/\n", "<p>small</p>"), (5, "http://e/", None), (None, "http://f/", big), (7, "http://g/", "x" * 999), (8, "http://h/", "x" * 999)]
    rows += [(20, "http://t/", "y" * 2000), (20, "http://t/", "y" * 2000)]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


@pytest.mark.parametrize("groups", [200_000, 0])
def test_round_trip(pages, spark, monkeypatch, groups):
    monkeypatch.setattr(warc, "BROADCAST", groups)
    got = warc.round_trip(pages, payloads=True).collect()
    assert len(got) == pages.count()
    by = {x.page_id: x for x in got}
    assert [(by[k].record_type, by[k].refers_to) for k in (9, 1, 2, None)] == [("response", None), ("revisit", 9), ("revisit", 9), ("revisit", 9)]
    assert all(by[k].record_type == "response" for k in (3, 4, 5, 7, 8, 20))
    for x in pages.collect():
        payload = (x.html or "").encode()
        y = by[x.page_id]
        assert (y.payload_bytes, y.payload_digest) == (len(payload), hashlib.sha1(payload).hexdigest())
        assert y.html == (x.html or "") or y.record_type == "revisit"
    assert by[4].url == "http://d/%0A" and by[9].url is None
    assert warc.round_trip(pages.where("false")).count() == 0


def archive(records, content=b"dictionary of bytes: WARC/1.1\r\nWARC-Type: response", pressed=False):
    press = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(content))
    held = zstandard.ZstdCompressor().compress(content) if pressed else content
    return struct.pack("<II", warc.DICTIONARY_MAGIC, len(held)) + held + b"".join(press.compress(r) for r in records)


@pytest.mark.parametrize("pressed", [False, True])
def test_reader_takes_one_frame_per_record(monkeypatch, pressed):
    records = [warc.page_record(i, "http://x/", b"payload %d " % i * i, None) for i in range(40)]
    for chunk in (9, 100, 1 << 16):
        monkeypatch.setattr(warc, "CHUNK", chunk)
        assert list(warc.frames(io.BytesIO(archive(records, pressed=pressed)))) == records
    assert [warc.parse(r)["page_id"] for r in records] == list(range(40))


def test_archives_are_what_other_readers_take(pages, spark, tmp_path):
    """On disk: the dictionary's skippable frame first, then frames that a plain decoder with that dictionary reads, one record each."""
    (made, *_) = warc.write(pages.coalesce(1), f"file://{tmp_path}/plain").collect()
    data = (tmp_path / "plain" / made.path.rsplit("/", 1)[1]).read_bytes()
    magic, size = struct.unpack("<II", data[:8])
    assert magic == 0x184D2A5D and len(data) == made.bytes
    decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8 : 8 + size]))
    out = decoder.stream_reader(io.BytesIO(data[8 + size :]), read_across_frames=True).read()
    assert out.count(b"WARC/1.1\r\n") == made.records + 1


def test_records_of_any_kind(spark, tmp_path):
    """An archive that others might have written: WARC/1.0, requests, metadata, no digest, repeated HTTP headers, bytes that are no text."""
    head = lambda kind, *more: [("WARC-Record-ID", f"<urn:uuid:{kind}>"), ("WARC-Date", warc.DATE), *more]
    http = ("Content-Type", "application/http;msgtype=response")
    made = [
        warc.record("warcinfo", head("warcinfo"), b"software: a crawler\r\n"),
        warc.record("request", head("request", ("Content-Type", "application/http;msgtype=request"), ("WARC-Target-URI", "http://a/")), b"GET / HTTP/1.1\r\nHost: a\r\n\r\n"),
        warc.record("response", head("response", http, ("WARC-Target-URI", "http://a/")), b"HTTP/1.1 200 OK\r\nSet-Cookie: a\r\nSet-Cookie: b\r\n\r\n\xff\xfe\x00").replace(b"WARC/1.1", b"WARC/1.0", 1),
        warc.record("metadata", head("metadata"), b""),
    ]
    press = zstandard.ZstdCompressor()
    (tmp_path / "other.warc.zst").write_bytes(b"".join(press.compress(x) for x in made))
    paths = spark.createDataFrame([(f"file://{tmp_path}/other.warc.zst",)], "path string")
    got = {x.record_type: x for x in warc.records(paths).collect()}
    assert list(map(len, (got, made))) == [4, 4] and bytes(got["response"].payload) == b"\xff\xfe\x00" and got["response"].http["set-cookie"] == "a, b"
    assert got["request"].status == "GET / HTTP/1.1" and got["metadata"].target_uri is None and bytes(got["metadata"].payload) == b""
    with pytest.raises(warc.BadArchive, match="digest"):
        warc.parse_any(warc.record("resource", head("resource", ("WARC-Block-Digest", "sha1:" + "A" * 32)), b"x"))


def test_reader_refuses_what_is_broken():
    good = warc.page_record(1, "http://x/", b"payload", None)
    assert warc.parse(good)["html"] == "payload"
    for bad in (good[:-1], good + b"x", good.replace(b"WARC/1.1", b"WARC/0.9"), good.replace(b"payload", b"Payload"), good.replace(b"WARC-Date", b"WARC-Record-ID"), good.replace(b"Content-Length: 7", b"Content-Length: 8"), b"WARC/1.1"):
        with pytest.raises(warc.BadArchive):
            warc.parse(bad)
    data = archive([good, good])
    for bad in (data[:-3], data[:20], b"\x00" * 12, data + b"junkjunkjunk"):
        with pytest.raises(warc.BadArchive):
            list(warc.frames(io.BytesIO(bad)))


def test_manifest_counts_are_held_to(pages, tmp_path):
    manifest = warc.write(pages, f"file://{tmp_path}/w")
    assert warc.read(manifest).count() == pages.count()
    with pytest.raises(Exception, match="listed"):
        warc.read(manifest.withColumn("records", F.col("records") + 1)).collect()


# --- extraction -------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var a="</p>";</script></head><body>
<header><h2>Site</h2></header><nav><ul><li><a href=/>Home</a></li></ul></nav><div class="cookie-notice">We use cookies for all that you do here and more.</div>
<article><h1>A  title &amp; more</h1><p>First <b>bold</b>
 words.</p><div class="ad"><p>Buy this wonderful thing now, it is cheap and good.</p></div><p>Short.<p>Unclosed &eacute; one<br>line</p><form><input value=x>send</form>
<aside>Aside text that is not wanted</aside></article><section id="comments"><p>A reader's long comment about the whole article, which nobody wants to keep.</p></section>
<footer>&copy; x</footer></body></html>"""


def test_empty_comments_end_where_they_begin():
    text = "A first paragraph that is long enough to be the article's own, with a clause or two."
    for comment in ("<!-->", "<!--->", "<!---->", "<!-- a > b -->", "<!--->-->"):
        page = f"<html><body><article><p>{text}</p>{comment}<p>{text} Again.</p></article></body></html>"
        want = text + "\n" + ("-->" + "\n" if comment == "<!--->-->" else "") + text + " Again."
        assert extract.main_text(page) == want, comment


def test_marked_page():
    assert extract.main_text(PAGE) == "A title & more\nFirst bold words.\nShort.\nUnclosed é one line"


def test_unmarked_page():
    long = ["This paragraph is long enough to be a part of the story, as all of them are, number %d." % i for i in range(5)]
    body = "".join(f"<p>{x}</p>" for x in long[:3]) + "<p>Short.</p>" + "".join(f"<p>{x}</p>" for x in long[3:])
    page = "<div><a href=1>One</a></div><div><a href=2>Two</a></div><div><a>x</a></div><div>.</div>" + body + "<div>.</div><div>.</div><div>.</div><div>Imprint</div>"
    assert extract.main_text(page) == "\n".join([*long[:3], "Short.", *long[3:]])


@pytest.mark.parametrize(
    ("page", "text"),
    [(None, ""), ("", ""), ("<p>", ""), ("<p>only", "only"), ("<p>cut <b>of", "cut of"), ("<p>a</p><p class='x", "a"), ("<script>var x", ""), ("<!-- all of it", "")]
    + [("<nav><p>never ends", "never ends"), ("<article><p>a&ampb &#x41;&lt;</p>", "a&b A<"), ("a < b", "a < b"), ("<div class=menu>m</div><main>t</main>", "t")],
)
def test_odd_pages(page, text):
    assert extract.main_text(page) == text


@pytest.mark.parametrize(
    ("inner", "text"),
    [("<p class=notice>Ad<p>Para 1<p>Para 2", "Para 1\nPara 2"), ("<p>Before<div class=ad>Ad<p>Para 1</p><p>Para 2</p>", "Before\nAd\nPara 1\nPara 2")]
    + [("<ul><li>one<li class=share>Share<ul><li>on</ul><li>two</ul><p>After", "one\ntwo\nAfter"), ("<dl><dt class=ad>x<dd>y</dl>z", "y\nz")]
    + [("<table><tr><td>a<tr class=ad><td>Ad<tr><td class=ad>Ad<td>b</table><p>After", "a\nb\nAfter"), ("<p>a <span class=ad>Ad</p><p>b", "a\nb")]
    + [("<section><div class=ad><b>Ad</section><p>After", "After"), ("<div class=ad><div>Ad</div>Ad</div><p>After", "After"), ("<p>One<nav>x<p>Two", "One\nx\nTwo")],
)
def test_unwanted_elements_without_end_tag(inner, text):
    assert extract.main_text(f"<body><article><h1>Title</h1>{inner}</article><p>Out</body>") == f"Title\n{text}"


LONG = "This paragraph is long enough to be a part of the story, as all of them are."
LINKS = "<ul><li><a href=1>One link</a></li><li><a href=2>Another link</a></li><li><a href=3>The last</a></li></ul>"


@pytest.mark.parametrize(
    "blocks",
    [[LONG, "Three short", "lines", "apart", "A paragraph of some sixty characters, which is below 86.", "Short", "lines", "again", LONG]]
    + [["A short heading", LONG, LONG, "The end."], ["Roses are red", "Violets are blue", "Sugar is sweet", "And so are you"], ["你好吗？", "我很好。", "谢谢你。", "再见。"]]
    + [[LONG, *(f"Item {i}" for i in range(9)), LONG]],
)
def test_unmarked_page_keeps_short_lines(blocks):
    body = "".join(f"<p>{x}</p>" for x in blocks)
    assert extract.main_text(f"<body>{LINKS}{body}{LINKS}</body>") == "\n".join(blocks)


def test_unmarked_page_keeps_a_paragraph_set_apart():
    apart = "A paragraph of some sixty characters, which is below 86."
    assert extract.main_text(f"<body><p>{LONG * 4}</p>{LINKS}<p>{apart}</p>{LINKS}<p>{LONG}</p></body>") == f"{LONG * 4}\n{apart}\n{LONG}"


@pytest.mark.parametrize("wrapper", ["div class='content has-sidebar'", "div id=no-comments", "article class='post no-comments'", "div class=search-prices", "div class='page sidebar'", "form id=all"])
def test_wrapper_is_not_what_its_name_holds(wrapper):
    page = f"<body>{LINKS}<{wrapper}><h1>Title</h1><p>{LONG}</p><div class='ad-box'>Buy this</div><p>{LONG}</p></{wrapper.split()[0]}><div id=comments><p>A comment</p></div></body>"
    assert extract.main_text(page) == f"Title\n{LONG}\n{LONG}"


def test_distribution_decides_in_marked_articles():
    """Rows of links before and after the text of an article lie outside surge and dive; those within a run stay."""
    links = "".join(f"<p><a href=/{k}>Tag number {k}</a></p>" for k in range(4))
    text = "".join(f"<p>A paragraph of the article that has some length, number {k}.</p>" for k in range(3))
    page = f"<article><h1>A title</h1>{text}<p><a href=/x>see also</a></p>{text}{links}<p>ok</p></article>"
    got = extract.main_text(page).split("\n")
    assert got[0] == "A title" and got[4] == "see also" and len(got) == 8
    assert extract.main_text(page, window=10) != extract.main_text(page)  # wider windows bridge the links
    assert extract.main_text(f"<article>{links}</article>").count("\n") == 3  # nothing but links


def test_very_long_and_broken_pages_are_quick():
    import time

    began = time.time()
    extract.main_text("<p " * 50_000 + "\"'" * 50_000)
    assert extract.main_text("<article>" + "<p>word word</p>" * 50_000 + "</article>").count("\n") == 49_999
    extract.main_text("<div class=ad>" * 20_000)
    assert time.time() - began < 30


def test_extract_frames(spark, small):
    rows = [(None, None, None), (1, "u", PAGE), (1, "u", PAGE)]
    got = extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))).collect()
    assert len(got) == 3 and got[0].text == "" and got[1].n_chars == len(got[1].text)
    pages = spark.read.parquet(f"{small}/pages.parquet").limit(0)
    assert extract.extract(pages).count() == 0


# --- pipeline ---------------------------------------------------------------


def test_pipeline(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "mixing", "sharding"]
    now, counts = docs, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, small)
        assert now.columns == docs.columns
        counts.append(now.count())
    assert docs.count() > counts[0] > counts[1] > counts[2] and counts[3] >= counts[2]
    got = corpus_pipeline.run(spark, small).collect()
    assert len(got) == counts[3] and {x.doc_id for x in got} == {x.doc_id for x in now.collect()}


def test_pipeline_by_brute_force(spark, small):
    """Every stage on what its predecessor kept: scores, all pairs of fingerprints, all passages, budgets, and the SQL of the last."""
    from tickweave.llm import mixing, quality, sharding

    docs = spark.read.parquet(f"{small}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["quality"](spark, docs, small).cache()
    model = quality.learn(docs, spark.read.parquet(f"{small}/labels.parquet"))
    assert {x.doc_id for x in kept.collect()} == {x.doc_id for x in quality.score(docs, model).collect() if x.score >= 0.7}

    texts = {x.doc_id: x.text for x in kept.collect()}
    prints = {k: neardup.fingerprint(v.encode()) for k, v in texts.items()}
    root = {k: k for k in texts}
    for a, b in itertools.combinations(sorted(texts), 2):
        if (prints[a] ^ prints[b]).bit_count() <= 3 and root[a] != root[b]:
            low, high = sorted((root[a], root[b]))
            root = {k: low if v == high else v for k, v in root.items()}
    once = stages["near_duplicates"](spark, kept, small).cache()
    assert {x.doc_id: x.text for x in once.collect()} == {k: texts[k] for k in set(root.values())}

    items = [decontaminate.Item(x.item_id, decontaminate.normal(x.text), int(0.08 * len(decontaminate.normal(x.text)))) for x in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    held = lambda t: any(decontaminate.myers(i.peq, len(i.text), decontaminate.normal(t), i.budget) for i in items)
    clean = stages["decontamination"](spark, once, small).cache()
    assert {x.doc_id for x in clean.collect()} == {k for k in set(root.values()) if not held(texts[k])}

    mixed = stages["mixing"](spark, clean, small).cache()
    read = Counter(x.doc_id for x in mixed.collect())
    plan = {x.source: x for x in mixing.mix(clean).collect()}
    for source, x in plan.items():
        mine = {r.doc_id: len(mixing_words(r.text)) for r in clean.collect() if r.source == source}
        assert {read[k] for k in mine} <= {int(x.readings), int(x.readings) + 1}
        assert 0 <= sum(read[k] * n for k, n in mine.items()) - int(x.readings * sum(mine.values())) <= max(mine.values()) + 1

    con = duckdb.connect()
    con.register("documents", mixed.toArrow())
    columns = "doc_id, source, size, text_crc32, law, shard, slot"
    want = sorted(map(tuple, con.execute(f"SELECT {columns} FROM ({sharding.sql()})").fetchall()))
    assert sorted(tuple(x) for x in stages["sharding"](spark, mixed, small).select(columns.split(", ")).collect()) == want


def mixing_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def test_pipeline_stages_on_odd_and_no_rows(spark, odd_docs, no_docs, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([(1, 1, 0), (3, 0, 0), (7, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, "no id here at all that long")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    for docs in (odd_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, docs, folder).count() <= docs.count() * 2
