"""Secret scan, fill-in-the-middle and periodic runs against plain versions, and their awkward rows."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_edge_rows import CLASHES, LONG, ROWS, SCHEMA

from lodestar.llm import fill_in_middle as fim
from lodestar.llm import kernel as K
from lodestar.llm import periodic_runs, secret_scan
from lodestar.llm.queries import _with_tails


@pytest.fixture(scope="module")
def docs(spark):
    d = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    return d.select("*", *[F.lit("clash").alias(c) for c in [*CLASHES, "runs", "spans", "output", "form", "words", "a", "p", "g"]])


def _lists(rows, column):
    out = {}
    for r in rows:
        out.setdefault(r["doc_id"], []).append(r[column])
    return out


# ---- fill-in-the-middle

def plain_fim(doc_id, text):
    """The contract, by string slicing."""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    h = hashlib.sha256(f"42:{doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    a, z = sorted((h1 % (n + 1), h2 % (n + 1)))
    before, middle, after = ("".join(units[i:j]) for i, j in ((0, a), (a, z), (z, n)))
    if h4 % 100 < 80:
        return n, "spm", len(before), len(middle), f"<S>{after}<P>{before}<M>{middle}"
    return n, "psm", len(before), len(middle), f"<P>{before}<S>{after}<M>{middle}"


def test_fill_in_middle_is_the_plain_one(spark):
    rng = random.Random(5)
    pieces = ["a", "é", "😀b", " ", "\n", "\t ", "<", "S>", "<P", ">", "word", "中文 ", "\x0b", " ", "<S>", "<M>"]
    rows = [(i, "".join(rng.choice(pieces[:-2] if rng.random() < .9 else pieces) for _ in range(rng.randrange(40)))) for i in range(600)]
    back = fim.restore(fim.transform(spark.createDataFrame(rows, "doc_id bigint, text string"))).collect()
    texts = dict(rows)
    for r in back:
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == plain_fim(r["doc_id"], texts[r["doc_id"]])
        assert r["restored"] == texts[r["doc_id"]]
    assert {r["form"] for r in back} == {"plain", "spm", "psm"}


@pytest.mark.parametrize("n", [0, 1, 2, 5, fim.BLOCK, 3 * fim.BLOCK + 7])
def test_rotation_in_place(n):
    a = np.random.default_rng(n).integers(0, 255, n, dtype=np.uint8)
    for m in sorted({0, 1, n // 3, n // 2, n} - ({1} if n < 1 else set())):
        b = a.copy()
        fim.rotate(b, 0, m, n)
        assert (b == np.concatenate([a[m:], a[:m]])).all()
        fim.rotate(b, 0, n - m, n)
        assert (b == a).all()


def test_fill_in_middle_awkward_rows(docs):
    back = fim.restore(fim.transform(docs, fim.Draw(rate=100))).collect()
    texts = {}
    for r in ROWS:
        texts.setdefault(r[0], r[1] or "")
    assert len(back) == len(ROWS) and all(r["restored"] == texts[r["doc_id"]] for r in back)
    form, n, out = (_lists(back, c) for c in ("form", "n", "output"))
    assert form[3] == form[4] == ["plain"] and out[4] == [""] and n[4] == [0] and n[6] == [1] and n[5] == [60_001]
    assert form[5] != ["plain"] and out[2][0] == out[2][1]
    assert fim.restore(fim.transform(docs.limit(0))).count() == 0


# ---- periodic runs

def plain_runs(words, least, times):
    """Every maximal stretch of every period; of one stretch the smallest period."""
    n, best = len(words), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least, times * q):
                best.setdefault((i, length), q)
            i = j + 1
    return sorted((s, length, q) for (s, length), q in best.items())


def plain_collapse(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def _texts_with_runs(rng):
    for k in range(150):
        words = [rng.choice("abc"[:1 + k % 3]) for _ in range(rng.randrange(60))]
        for _ in range(k % 4):
            p = [rng.choice(["ä", "b", "c d", "中"]) for _ in range(rng.randrange(1, 9))]
            at = rng.randrange(len(words) + 1)
            words[at:at] = (p * 6)[:rng.randrange(2, 6) * len(p) + rng.randrange(len(p))]
        yield rng.choice([" ", "\n", " \t "]).join(words)


@pytest.mark.parametrize("least,times", [(24, 3), (1, 2), (6, 3), (10, 2)])
def test_runs_are_the_plain_ones(spark, least, times):
    texts = list(_texts_with_runs(random.Random(least)))
    got = periodic_runs.collapse_runs(
        spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(2), least, times).collect()
    some = 0
    for r in got:
        words = texts[r["doc_id"]].split()
        runs = [tuple(x) for x in r["runs"]]
        assert runs == plain_runs(words, least, times), texts[r["doc_id"]]
        assert r["collapsed"] == plain_collapse(words, runs) and r["n_words"] == len(words)
        some += bool(runs)
    assert some > 10


def test_runs_of_long_and_close_texts():
    """Runs stay in their text although equal words go on in the next one; a long period needs high levels."""
    rng = np.random.default_rng(3)
    period = rng.integers(1, 1 << 60, 5000, dtype=np.uint64)
    a, b = np.tile(period, 4)[:17_001], np.full(40, 9, np.uint64)
    words = np.concatenate([a, b, b, b[:20]])
    first = np.cumsum([0, len(a), 40, 0, 40, 20])
    start, length, q = periodic_runs.find_runs(words, first)
    assert list(zip(start.tolist(), length.tolist(), q.tolist(), strict=True)) == [
        (0, 17_001, 5000), (17_001, 40, 1), (17_041, 40, 1)]


def test_runs_awkward_rows(docs):
    got = periodic_runs.collapse_runs(docs).collect()
    runs, text, n = (_lists(got, c) for c in ("runs", "collapsed", "n_words"))
    assert len(got) == len(ROWS) and runs[3] == runs[4] == runs[6] == [[]] and text[4] == text[6] == [""] and n[4] == [0]
    assert text[5] == [LONG] and text[2][0] == text[2][1]
    assert periodic_runs.collapse_runs(docs.limit(0)).count() == 0


def test_planted_tails(spark, docs):
    import zlib

    rows = [(i, f"one  two\nthree {'x ' * (i % 50)}four") for i in range(300)] + [(30, None)]
    got = {(r["doc_id"], r["text"] is None): r["text"] for r in _with_tails(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    tenth = 0
    for i, text in rows[:300]:
        words, h = text.split(), zlib.crc32(str(i).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % len(words)
            p = 1 + (len(words) - a) // (3 + g % 8)
            words, tenth = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)], tenth + 1
        assert got[i, False].split() == words
    assert tenth > 15 and _with_tails(docs).count() == len(ROWS)


# ---- secrets

SECRET = "q9Zt4LmX7vB2kR8wPn3Y"


def plain_base(text):
    """The base patterns on code points."""
    assign = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
    out = [(0, *m.span()) for m in assign.finditer(text) if len(m.group(2)) >= 6]
    out += [(1, *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    out += [(2, *m.span()) for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 24]
    return [(secret_scan.KINDS[k], s, e) for s, k, e in sorted((s, k, e) for k, s, e in out)]


def test_base_spans_are_the_plain_ones(spark):
    rng = random.Random(8)
    parts = ["password", "PassWd", "tOken", "api_key", "APIKEY", "ſecret", "toKen", "secret", "'", '"', " ", "  ", ":", "=", "==", "\n", "é", "😀",
             "abcdef", "abc", "x+/=_.-", "AKIA", "AKIA" + "Z9" * 9, "0123456789abcdef", "deadbeef" * 3, "F", "g", "akia"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randrange(40)))) for i in range(800)]
    got = secret_scan.scan_secrets(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()
    texts, kinds = dict(rows), set()
    for r in got:
        base = [(s["kind"], s["start"], s["end"]) for s in r["spans"] if s["kind"] != "novel"]
        assert base == plain_base(texts[r["doc_id"]]), texts[r["doc_id"]]
        kinds |= {k for k, _, _ in base}
    assert len(got) == 800 and kinds == {"assign", "access", "hex"}


def test_novel_strings_beside_sensitive_words(spark):
    names = " ".join(f"connection{w} default{w} timeout" for w in ("Manager", "Factory", "Pool", "Timeout"))
    code = [(100 + i, f"é open {names} for request and close the connectionPool{i}") for i in range(40)]
    rows = [(1, f"é the bearer is {SECRET} and no more"), (2, f"credential {SECRET}\n{SECRET}"), (3, f"just {SECRET} alone"),
            (4, "the bearer defaultTimeout_connectionManager1 connectionPool2"), (5, f"bearer\n{SECRET}"), (6, f"author {SECRET}"),
            (7, f"secret={SECRET}"), (8, "credential " + "abcd" * 8 + "1"), *code]
    got = _lists(secret_scan.scan_secrets(spark.createDataFrame(rows, "doc_id bigint, text string")).collect(), "spans")
    for i, text in rows:
        novel = [text[s["start"]:s["end"]] for s in got[i][0] if s["kind"] == "novel"]
        assert novel == ([SECRET] if i in (1, 2) else []), (i, got[i])
    assert [s["kind"] for s in got[7][0]] == ["assign"]


def test_novelty_is_marginal(spark):
    text = b"open connectionManager " + SECRET.encode()
    measure = secret_scan.Novelty(b"open connectionManager connectionFactory", secret_scan.Scan())
    assert measure(text, 5, 22) < 0.4 < 0.7 < measure(text, 23, len(text))
    same = text + b" " + SECRET.encode()
    assert abs(measure(same, 23, len(text)) - measure(text, 23, len(text))) < 0.11


def test_identifiers_count_every_text(spark):
    rows = [(i, "alpha alpha beta_x" if i % 3 else "alpha gamma9 delta " * 3) for i in range(90)] + [(None, None), (1, "x")]
    d = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert secret_scan.identifiers(d) == b"delta beta_x alpha"
    assert secret_scan.identifiers(d, secret_scan.Scan(dictionary=10)) == b"alpha"
    assert secret_scan.identifiers(d.limit(0)) == b""


def test_secrets_awkward_rows(docs):
    got = secret_scan.scan_secrets(docs)
    rows = got.collect()
    assert len(rows) == len(ROWS) and not any(r["spans"] for r in rows)
    assert secret_scan.scan_secrets(docs.limit(0)).count() == 0


def test_hex_spans_stay_in_their_text():
    data = np.frombuffer(b"a" * 30 + b"b" * 23, np.uint8)
    start, end, first = secret_scan.hex_spans(data, np.array([0, 30, 53]))
    assert start.tolist() == [0] and end.tolist() == [30] and first.tolist() == [0, 1, 1]
    assert K.WORD_BYTES[97]


def test_registered_queries_carry_the_operators_results(spark, tmp_path):
    import __spark_entry__ as E

    rows = [(1, f"é token = {SECRET}"), (2, "spam " * 40), (3, None), (30, "one two three " * 20)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in E.queries()["op11_secret_scan"](spark, str(tmp_path)).collect()}
    assert (got[1]["n_assign"], got[1]["n_access"], got[1]["n_hex"], got[1]["spans"]) == (1, 0, 0, "assign:2:30")
    assert got[1]["base_sha256"] == hashlib.sha256(b"assign:2:30").hexdigest() and got[3]["spans"] == ""
    got = {r["doc_id"]: r for r in E.queries()["op13_periodic_runs"](spark, str(tmp_path)).collect()}
    assert (got[2]["n_runs"], got[2]["start"], got[2]["length"], got[2]["period"], got[2]["exponent_milli"]) == (1, 0, 40, 1, 40_000)
    assert got[2]["collapsed_sha256"] == hashlib.sha256(b"spam").hexdigest() and got[3]["n_runs"] == 0 and got[3]["start"] is None
