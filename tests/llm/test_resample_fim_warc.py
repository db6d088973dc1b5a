"""Importance resampling, fill-in-the-middle forms and WARC archives against plain loops."""

import gzip
import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stintlake.llm import fim, importance, warc

EXTRA = "score string, rank string, id string, row string, n string, fim string, shard int, same string, first string"


def make(spark, rows, schema):
    return spark.createDataFrame([(*r, "x", "y", "z", "w", "v", "u", 1, "s", "f") for r in rows], f"{schema}, {EXTRA}")


def digits(seed, doc_id, group):
    return int(hashlib.sha256(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()[8 * group - 8 : 8 * group], 16)


# --- 11: importance resampling ---------------------------------------------------------------------------


def plain_resampling(docs, target, low=1, high=1, buckets=10_000, least=20, percent=10):
    def runs(text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        return len(w), [zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(low, high + 1) for i in range(len(w) - n + 1)]

    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(runs(text)[1])
    for text in target:
        t.update(runs(text)[1])
    of_s, of_t = float(sum(s.values()) + buckets), float(sum(t.values()) + buckets)
    out = []
    for doc_id, text in docs:
        n, found = runs(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1.0) * of_s / ((s[b] + 1.0) * of_t))) for b in found)
        out.append([doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((digits(2024, doc_id, 1) + 0.5) / 4294967296))), n >= least])
    order = sorted((k for k in range(len(out)) if out[k][4]), key=lambda k: (-out[k][3], -1 if out[k][0] is None else out[k][0], out[k][1], out[k][2]))
    rank = {k: i for i, k in enumerate(order[: percent * len(order) // 100], 1)}
    return sorted(((*r[:4], rank.get(k)) for k, r in enumerate(out)), key=repr)


def resample_corpus():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdeÄß7") for _ in range(rng.randrange(1, 4)))
    texts = [None, "", "  !! ", "One TWO Ünder ÜNDER x_y 3.14", " ".join(word() for _ in range(30_000))]
    texts += [" ".join(word() for _ in range(rng.randrange(1, 120))) for _ in range(150)]
    docs = list(enumerate(texts)) + [(200, texts[30])] * 40 + [(None, texts[31]), (201, "the same " * 15), (202, "the same " * 15), (203, texts[30])]
    return docs, [None, "", "the same the same one"] + [" ".join(word() for _ in range(50)) for _ in range(20)]


@pytest.mark.parametrize(("low", "high", "percent"), [(1, 1, 10), (1, 3, 50), (2, 2, 100)])
def test_resampling_matches_a_loop(spark, low, high, percent):
    docs, target = resample_corpus()
    got = importance.resample(make(spark, docs, "doc_id long, text string"), spark.createDataFrame([(t, 1) for t in target], "text string, doc_id int"), low=low, high=high, percent=percent)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_resampling(docs, target, low, high, percent=percent)
    assert [t for _, t in got.dtypes] == ["bigint"] * 5


def test_resampling_of_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    docs, target = resample_corpus()
    assert importance.resample(empty, spark.createDataFrame([("a b",)], "text string")).collect() == []
    got = importance.resample(make(spark, docs, "doc_id long, text string"), empty)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_resampling(docs, [])


def test_weights_from_planes_are_exact():
    rng = np.random.default_rng(3)
    for size in (1, 63, 64, 65, 1000):
        for top in (1, 7, 9000):
            gain, count = rng.integers(-top, top + 1, size), rng.integers(0, 3000, size) * (rng.random(size) < 0.3)
            assert importance.weigh(count, importance.gain_planes(gain)) == int((gain * count).sum())
    assert importance.weigh(np.array([1 << 40, 0, 5]), importance.gain_planes(np.array([-3, 9, 0]))) == -3 * (1 << 40)
    for values in ([-8, 7], [-9, 8], [0], [-1]):  # the ends of what a number of bits can hold
        assert importance.weigh(np.ones(len(values), np.int64), importance.gain_planes(np.array(values))) == sum(values)


def test_draw_with_equal_scores(spark):
    scored = spark.createDataFrame([(k, 30, 5, 7) for k in range(100)], "doc_id long, n_features long, weight long, score long")
    got = {r.doc_id: r["rank"] for r in importance.draw(scored, F.col("n_features") >= 20, 25).collect()}
    assert got == {k: k + 1 if k < 25 else None for k in range(100)}


# --- 12: fill-in-the-middle ---------------------------------------------------------------------------------


def plain_form(doc_id, text, seed=7, rate=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n, h = len(units), [digits(seed, doc_id, k) for k in (1, 2, 3, 4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", text, None, None
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < spm:
        return n, "spm", f"<S>{s}<P>{p}<M>{m}", len(p), len(m)
    return n, "psm", f"<P>{p}<S>{s}<M>{m}", len(p), len(m)


def form_corpus():
    rng = random.Random(8)
    texts = [None, "", "\n", "\n\n\n", "x", "a\nb", "a\r\nb\rc d\u0085e\n", "$1 \\1 \\Q (?x) {2}", "<P", "<S\n<M\n<\n>", "a <P> b\nc", "<M>", "x<S>", "ü😀\n😀ß\n\n𝄞"]
    texts += ["".join(rng.choice("ab<SPM>\n\n😀") for _ in range(rng.randrange(1, 60))) for _ in range(400)]
    texts += ["line\n" * 200_000, "y" * 3_000_000, "\n" * 500_000, "word " * 50_000 + "\n" + "z" * 100_000]
    return [*enumerate(texts), (None, "p\nq\nr"), (7, "same id\nother text"), (5, "a\nb"), (5, "a\nb")]


@pytest.mark.parametrize(("rate", "spm"), [(100, 50), (60, 100), (0, 0)])
def test_forms_match_a_loop_and_come_back(spark, rate, spm):
    docs = form_corpus()
    df = make(spark, docs, "doc_id long, text string")
    made = fim.transform(df, "fim", form_percent=rate, spm_percent=spm)
    assert made.columns == [c for c in df.columns if c != "fim"] + ["fim"]
    got = [(r.doc_id, r.text, *r.fim, r.back, r.score) for r in made.withColumn("back", fim.restore(F.col("fim.output"), F.col("fim.form"))).collect()]
    want = [(i, t, *plain_form(i, t, rate=rate, spm=spm), t or "", "x") for i, t in docs]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_forms_of_other_units(spark):
    """Any unit that makes up the whole text: here single characters."""
    df = spark.createDataFrame([(k, "abcdefgh😀\n" * (k % 5)) for k in range(50)], "doc_id long, text string")
    for r in fim.transform(df, unit="(?s:.)").withColumn("back", fim.restore(F.col("fim.output"), F.col("fim.form"))).collect():
        n = len(r.text)
        assert r.fim.n == n and r.back == r.text
        if n:
            a, b = sorted((digits(7, r.doc_id, 1) % (n + 1), digits(7, r.doc_id, 2) % (n + 1)))
            assert (r.fim.prefix_chars, r.fim.middle_chars) == (a, b - a)


def test_report_of_forms(spark):
    docs = form_corpus()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = []
    for i, t in docs:
        n, form, output, p, m = plain_form(i, t)
        want.append((i, n, form, p, m, sha(output), sha(t or "")))
    got = fim.report(make(spark, docs, "doc_id long, text string"))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(want, key=repr)
    assert fim.report(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_forms_run_without_python(spark):
    plan = fim.report(make(spark, form_corpus()[:5], "doc_id long, text string"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and not re.search("Python|Arrow", plan)


# --- 13: WARC ----------------------------------------------------------------------------------------------------


def pages():
    rng = random.Random(4)
    rows = [(k, f"http://a.example/{k}", "".join(rng.choice("ab<p>é ") for _ in range(rng.randrange(0, 400)))) for k in range(120)]
    rows += [(k, f"http://b.example/{k}", "the same page") for k in range(300, 380)]
    rows += [(500, None, None), (501, "http://c.example/ü x\r\nWARC-Type: bad", ""), (502, "", "tail \r\n\r\n\r\n WARC/1.1\r\n")]
    rows += [(303, "http://b.example/303", "the same page")] * 3 + [(7, "http://z.example", "another payload of page 7"), (600, "u", "é" * 300_000)]
    return rows + [(None, "n", "the same page"), (None, "n", "only without id"), (None, "o", "only without id")]


def plain_archive(rows, least=0):
    first, seen, out = {}, set(), []
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    for i, u, h in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        body = (h or "").encode()
        to = first.get(h or "")
        revisit = len(body) >= least and (to != i if to is not None else (i, h) in seen)
        revisit = revisit or (len(body) >= least and (i, h or "") in seen)
        seen.add((i, h or ""))
        out.append((i, len(body), warc.digest(body), "revisit" if revisit else "response", to if revisit else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("least", [0, 14])
def test_archives_match_a_loop(spark, tmp_path, least):
    got = warc.archive(make(spark, pages(), "page_id long, url string, html string"), str(tmp_path / "w"), least)
    # a page without an id refers to no number, so its record names none
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_archive(pages(), least)


def test_archives_do_not_depend_on_partitions_and_roll(spark, tmp_path):
    df = make(spark, pages(), "page_id long, url string, html string")
    seen = []
    for k, frame in enumerate((df.coalesce(1), df.repartition(7, F.rand(3)))):
        base = f"{tmp_path}/{k}"
        manifest = warc.write(frame, base, roll=2000, shard_bytes=100_000)
        names = sorted(r.name for r in manifest.collect())
        assert sorted(f for f in os.listdir(base) if f.endswith(".gz")) == names and not os.path.exists(f"{base}/_temporary")
        seen.append({n: open(f"{base}/{n}", "rb").read() for n in names})
        for r in manifest.collect():
            assert len(seen[-1][r.name]) == r.bytes
    assert seen[0] == seen[1] and len(seen[0]) > 8 and len({n[:10] for n in seen[0]}) > 3
    # a file is closed by the first record that takes it over the limit
    sizes = [len(v) for v in seen[0].values()]
    assert all(s >= 2000 for n, s in zip(seen[0], sizes, strict=True) if f"{n[:11]}{int(n[11:16]) + 1:05d}.warc.gz" in seen[0])
    plain = gzip.decompress(b"".join(seen[0].values()))
    assert plain.count(b"WARC-Type: response\r\n") + plain.count(b"WARC-Type: revisit\r\n") == len(pages())


def test_archives_give_back_the_pages(spark, tmp_path):
    base = str(tmp_path / "w")
    rows = [(k, u, h) for k, u, h in pages() if k is not None]
    warc.write(make(spark, rows, "page_id long, url string, html string"), base, shard_bytes=5000)
    got = warc.read(spark, base).collect()
    payload = {r.page_id: r.payload for r in got if r.record_type == "response" and r.page_id != 7}
    for r in got:
        body = payload[r.refers_to] if r.record_type == "revisit" else r.payload
        assert len(body) == r.payload_bytes and warc.digest(bytes(body)) == r.payload_digest
        assert r.page_id == 7 or bytes(body).decode() == next(h or "" for k, _, h in rows if k == r.page_id)
    urls = {r.page_id: r.url for r in got}
    assert urls[500] is None and urls[3] == "http://a.example/3" and "\r" not in urls[501] and urls[502] == ""
    # every record can be read on its own from its offset
    r = next(r for r in got if r.page_id == 5)
    with open(f"{base}/{r.name}", "rb") as f:
        f.seek(r.offset)
        _, fields, block = next(warc.records(iter([f.read()]), r.name))
    assert fields["WARC-Record-ID"] == "<urn:page:5>" and block.endswith(bytes(r.payload))


def test_only_accepted_attempts_count(spark, tmp_path):
    """What a lost attempt left behind is neither renamed nor read, and renaming twice does no harm."""
    base = str(tmp_path / "w")
    os.makedirs(f"{base}/_temporary")
    open(f"{base}/_temporary/lost-part-00000-00000.warc.gz", "wb").write(b"half a rec")
    open(f"{base}/_temporary/good-part-00000-00000.warc.gz", "wb").write(warc.page_record("1", "u", b"p", None))
    done = spark.createDataFrame([(0, 0, "part-00000-00000.warc.gz", "good-part-00000-00000.warc.gz", 1, 1, 1, 1)], warc._MANIFEST)
    warc._commit(done, base)
    os.rename(f"{base}/manifest", f"{base}/gone")
    warc._commit(done, base)
    assert [(r.page_id, bytes(r.payload)) for r in warc.read(spark, base).collect()] == [(1, b"p")]
    with pytest.raises(ValueError, match="manifest already"):
        warc.write(spark.createDataFrame([], "page_id long, url string, html string"), base)


def test_damage_is_an_error(tmp_path):
    good = warc.page_record("1", "u", b"payload", None)
    assert len(list(warc.records(iter([good[:10], good[10:] + good]), "f"))) == 2
    with pytest.raises(ValueError, match="ends too early"):
        list(warc.records(iter([good[:-20]]), "f"))
    _, fields, block = next(warc.records(iter([good]), "f"))
    with pytest.raises(ValueError, match="block's digest"):
        warc.checked(fields, block + b"x", "f")
    with pytest.raises(ValueError, match="payload differs"):
        warc.checked({**fields, "WARC-Block-Digest": f"sha1:{warc.digest(block + b'x')}"}, block + b"x", "f")


def test_empty_archive(spark, tmp_path):
    assert warc.archive(spark.createDataFrame([], "page_id long, url string, html string"), str(tmp_path / "w")).collect() == []
