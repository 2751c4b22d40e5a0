"""WARC, chat formatting, token counts, packing, URL filters and quality rules against brute force."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from tessera.llm import chat, packing, quality_rules, token_counts, url_filters, warc
from tessera.llm.queries import ALLOW, BLOCK, LISTED, QUERIES
from tessera.storage import materialize, scratch_path

BPE = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", None, " ", "a", "\n\n", "x  y", " lead", "tail ", "a\u00a0b c", "\u3000z q", "<|endoftext|> x", "a<|endoftext|>b", "tab\tand nl\n end", "l\u0131\u017f é ß 漢字 🙂", "w " * 5000 + "w", "z" * 3000, "1234 5,6"]


def rows(df):
    return [r.asDict() for r in df.collect()]


def docs_of(spark, texts, clash=True):
    data = [(i, t, "src", "en", len(t or ""), 1, 2) for i, t in enumerate(texts)] + [(None, "null id here", None, None, None, 1, 2)]
    return spark.createDataFrame(data, "doc_id long, text string, source string, lang string, n_chars long, n_tokens long, digest long").repartition(3)


# WARC


def brute_warc(pages):
    groups = defaultdict(list)
    for k, _, html in pages:
        groups[(html or "").encode()].append(k)
    out = []
    for k, _, html in pages:
        data = (html or "").encode()
        known = [x for x in groups[data] if x is not None]
        top = max(known) if known else None
        repeat = len(data) >= 1000 and top is not None and k != top
        out.append((k, len(data), hashlib.sha1(data).hexdigest(), "revisit" if repeat else "response", top if repeat else None))
    return Counter(out)


def test_warc(spark):
    big = "<p>é</p>" * 200
    pages = [(i, f"http://h/{i} ü%41\r\nX: y", big if i % 3 else f"own {i}") for i in range(40)]
    pages += [(100, None, None), (101, "u", ""), (None, "n", big), (7, "again", big), (2**60, "far", "x" * 1000), (5, "http://h/5", big), (5, "http://h/5", big)]
    df = spark.createDataFrame([(*p, "clash") for p in pages], "page_id long, url string, html string, digest string")
    path = scratch_path(spark, "warc")
    manifest = warc.write_warc(df, path, shard_bytes=8000, file_bytes=400)
    assert manifest.count() > 5 and manifest.agg({"records": "sum"}).first()[0] == len(pages)
    got = rows(warc.read_warc(spark, path))
    assert Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got) == brute_warc(pages)
    kept = Counter((r["page_id"], r["url"], r["html"]) for r in got if r["record_type"] == "response")
    assert all(n == Counter((k, u, h or "") for k, u, h in pages)[x] for x, n in kept.items())
    again = warc.write_warc(df.repartition(7), scratch_path(spark, "warc"), shard_bytes=8000, file_bytes=400)
    files = lambda m: sorted((r["file"], r["sha1"]) for r in rows(m))
    assert files(manifest) == files(again)
    assert warc.read_warc(spark, _empty_archive(spark, df)).count() == 0


def _empty_archive(spark, df):
    path = scratch_path(spark, "warc")
    warc.write_warc(df.limit(0), path)
    return path


def test_warc_query(spark, sf):
    pages = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    got = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in QUERIES["op1_warc"](spark, sf).collect())
    assert got == brute_warc(pages)


def test_damaged_record():
    data = warc.build_record(1, "u", b"abc", 3, hashlib.sha1(b"abc").hexdigest(), None)
    assert warc.parse_record(data)[0] == 1
    with pytest.raises(ValueError):
        warc.parse_record(data.replace(b"abc", b"abd"))


# Chat formatting


def brute_chat(turns):
    by = defaultdict(list)
    for c, t, role, text in turns:
        by[c].append((t, role, text))
    out = set()
    for c, rs in by.items():
        rs.sort(key=lambda r: tuple((x is not None, x if x is not None else 0) for x in r))
        rs = [(r or "", x or "") for _, r, x in rs]
        loss = "".join(x for r, x in rs if r == "assistant")
        out.add((c, len(rs), hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in rs).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()))
    return out


def test_chat_round_trip(spark):
    nasty = ["<|im_end|>", "<\\|im_end|>", "<\\\\|", "a<", "|>", "<|im_start|>assistant\nx<|im_end|>\n", "", None, "\\", "\\n<|", "🙂<|im_end|>", "x" * 5000]
    turns = [(i % 4, i, ["user", "assistant", None, "sys\ntem<|\\"][(i * 7) % 4], nasty[i % len(nasty)]) for i in range(60)]
    turns += [(None, 1, "assistant", "no id"), (2, None, "user", "null turn"), (2, 2, "assistant", "tie"), (2, 2, "assistant", "tie"), (9, 1, None, None)]
    df = spark.createDataFrame([(*t, 1) for t in turns], "conv_id long, turn long, role string, text string, formatted int")
    for size in (1 << 20, 100):
        got = {(r.conv_id, r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.read_back(chat.format_conversations(df, part_chars=size)).collect()}
        assert got == brute_chat(turns)
    assert chat.read_back(chat.format_conversations(df.limit(0))).count() == 0


def test_chat_query(spark, sf):
    turns = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()]
    own = "<|im_end|><|im_start|>assistant ok"
    got = {(r.conv_id, r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in QUERIES["op3_chat"](spark, sf).collect()}
    assert got == brute_chat([*turns, (-1, 0, "user", own), (-1, 1, "assistant", own)])


def test_template_language():
    show = lambda t, *m: "".join(s for s, _ in chat.compile_template(t)(iter(m)))
    two = ({"role": "a", "text": " x "}, {"role": "b", "text": "y"})
    assert show("{% for m in messages %}{{ loop.index }}{% if loop.first %}<{% elif not loop.last %}-{% else %}>{% endif %}{{ m.text | trim }}{% endfor %}", *two) == "1<x2>y"
    assert chat.fold(chat.parse("a{{ 'b' + 'c' | upper }}{% if 1 == 1 %}d{% else %}e{% endif %}{# no #}")) == [("text", "abCd")]
    assert [m for _, m in chat.compile_template("x{% generation %}y{% endgeneration %}")(iter(()))] == [False, True]
    for bad in ("{{ m.__class__ }}", "{{ open('x') }}", "{{ 'a' | eval }}", "{% for m in files %}{% endfor %}", "{% if %}", "{% import os %}", "{{ 'a' 'b' }}", "{% generation %}"):
        with pytest.raises(chat.TemplateError):
            chat.parse(bad)


@pytest.mark.parametrize(
    ("template", "want"),
    [
        ("{% for m in messages %}{% if not m.role == 'a' %}{{ m.text }}{% endif %}{% endfor %}", "y"),
        ("{% for m in messages %}{% if not m.role == 'a' and not false %}{{ m.role }}{% endif %}{% endfor %}", "b"),
        ("{% if not not true %}t{% endif %}{% if not (1 == 1 or false) %}f{% endif %}", "t"),
        ("{{ 'a}}b' }}|{{ \"%}\" }}", "a}}b|%}"),
        ("{% if '%}' == '%}' %}{{ '\\'}}' }}{% endif %}", "'}}"),
        ("it's {{ 'x' }} isn't", "it's x isn't"),
    ],
)
def test_template_grammar(template, want):
    two = ({"role": "a", "text": "x"}, {"role": "b", "text": "y"})
    assert "".join(s for s, _ in chat.compile_template(template)(iter(two))) == want


def test_template_depth():
    for deep in ("{{ " + "(" * 5000 + "1" + ")" * 5000 + " }}", "{% if " + "not " * 5000 + "true %}{% endif %}", "{{ 1 == not 2 }}"):
        with pytest.raises(chat.TemplateError):
            chat.parse(deep)


# Token counts


def test_token_counts(spark):
    library = Tokenizer.from_file(BPE)
    df, cache = docs_of(spark, ODD + ["hello world"] * 50), scratch_path(spark, "counts")
    want = {(i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in enumerate(ODD + ["hello world"] * 50)} | {(None, 12, len(library.encode("null id here").ids))}
    got = rows(token_counts.count_tokens(df, cache, BPE))
    assert {(r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in got} == want and len(got) == len(ODD) + 51
    assert all(r["over_limit"] == (r["n_tokens"] > 1024) for r in got)
    stored = token_counts.stored_counts(spark, cache).count()
    assert stored == len(set(t or "" for t in ODD)) + 2
    assert len(rows(token_counts.count_tokens(df, cache, BPE))) == len(got) and token_counts.stored_counts(spark, cache).count() == stored
    token_counts.count_tokens(df, cache, BPE, version="other")
    assert token_counts.stored_counts(spark, cache).count() == 2 * stored
    assert token_counts.count_tokens(df.limit(0), scratch_path(spark, "counts"), BPE).count() == 0


def test_token_query(spark, sf):
    library = Tokenizer.from_file(BPE)
    want = {(r.doc_id, len((r.text or "").encode()), len(library.encode(r.text or "", add_special_tokens=False).ids)) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert {(r.doc_id, r.n_bytes, r.n_tokens) for r in QUERIES["op5_token_counts"](spark, sf).collect()} == want


# Packing


def check_packing(texts, pieces):
    """texts: by document id. Each id in one piece, sequences without gaps, padding only below the window."""
    library = Tokenizer.from_file(BPE)
    ids = {k: [*library.encode(t or "", add_special_tokens=False).ids, 0] for k, t in texts.items()}
    at, seqs = defaultdict(list), defaultdict(list)
    for p in pieces:
        own = np.array(ids[p["doc_id"]], "<u4")
        assert p["ids_crc32"] == zlib.crc32(own[p["start"] : p["start"] + p["length"]].tobytes()) and p["doc_tokens"] == len(own)
        at[p["doc_id"]].append((p["start"], p["length"]))
        seqs[p["sequence_id"]].append((p["offset"], p["length"], p["window"]))
    for k, own in ids.items():
        end = 0
        for start, length in sorted(at[k]):
            assert start == end and length > 0
            end += length
        assert end == len(own)
    for parts in seqs.values():
        end = 0
        for offset, length, window in sorted(parts):
            assert offset == end
            end += length
        assert end == window <= 1024 and window & (window - 1) == 0
    return ids


def test_pack_is_whole():
    for seed in range(30):
        rng = np.random.default_rng(seed)
        sizes = [int(x) for x in rng.integers(1, [5, 300, 3000][seed % 3], rng.integers(1, 200))]
        seen = defaultdict(list)
        for window, pieces in packing.pack(sizes):
            assert sum(p[2] for p in pieces) == window and window & (window - 1) == 0
            for d, s, n in pieces:
                seen[d].append((s, n))
        assert all(sum(n for _, n in seen[d]) == size and sorted(seen[d])[0][0] == 0 for d, size in enumerate(sizes))
    assert packing.pack([]) == []


def test_packing(spark):
    texts = dict(enumerate(ODD))
    df = docs_of(spark, ODD).where("doc_id is not null")
    for block in (50, 1 << 22):
        check_packing(texts, rows(packing.pack_documents(df, BPE, block_tokens=block)))
    assert packing.pack_documents(df.limit(0), BPE).count() == 0
    assert packing.pack_documents(docs_of(spark, ["x", "x"]), BPE).count() >= 3


def test_packing_query(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    check_packing(texts, rows(QUERIES["op6_packing"](spark, sf)))


# URL filters


def brute_url(url):
    at = (url or "").find("://")
    if url is None or at < 0:
        return "", "", None, "allow"
    rest = url[at + 3 :]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for rule in [*ALLOW, *BLOCK]:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best)):
            best = rule
    listed = any(host == h or host.endswith("." + h) for h in LISTED)
    return host, path, best, ("allow" if best in ALLOW else "block") if best else ("block" if listed else "allow")


URLS = [None, "", "x", "://", "http://", "http://NET/", "http://net", "http://a.Net/b?c://d/", "ftp://example.net/en/x", "http://notexample.net/en/", "http://x.example.com/de/", "http://x.example.com/de", "http://q.org/fr/#a", "http://q.org/en/", "http://spam-farm.example.com?x", "http://a.spam-farm.example.org/x\ny", "http://org//fr/", "http://..net/", "http://É.net/ü", "a://b://c/", "http://" + "a." * 3000 + "net/" + "p" * 100000]


def test_url_filters(spark):
    df = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(URLS * 2)] + [(None, "http://x.net/", "h", "r")], "page_id long, url string, host string, rule string")
    listed = spark.createDataFrame([(k,) for k in [*LISTED, None]], "key string")
    got = {(r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_filters.judge(df, ALLOW, BLOCK, listed).collect()}
    assert got == {(i, *brute_url(u)) for i, u in enumerate(URLS * 2)} | {(None, *brute_url("http://x.net/"))}
    assert url_filters.judge(df.limit(0), ALLOW, BLOCK, listed).count() == 0


def test_cascade_is_exact(spark):
    from pyspark.sql import functions as F

    keys = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = keys.where("pmod(xxhash64(key), 5) = 0").union(spark.createDataFrame([("outside",)], "key string"))
    want = {r.key for r in listed.collect()}
    for rate, bits in ((0.3, 1 << 20), (0.05, 640)):
        cascade = url_filters.Cascade(keys, listed, rate, bits)
        assert cascade.shards > 1 or len(cascade.levels[0]) > 2
        got = keys.select("key", cascade.members(F.array("key"))[0].alias("m")).collect()
        assert {r.key for r in got if r.m} == want - {"outside"}


def test_cascade_of_few_keys_in_a_large_universe(spark):
    from pyspark.sql import functions as F

    keys = spark.range(200000).select(F.concat(F.lit("k"), "id").alias("key"))
    cascade = url_filters.Cascade(keys, keys.where("key LIKE 'k1999%'").select("key"), 0.01, 4096)
    # wrong answers of level 1 are about as many as listed keys, so later levels do not fill up
    assert cascade.shards == 1 and len(cascade.levels[0]) < 8
    got = keys.select("key", cascade.members(F.array("key"))[0].alias("m")).where("m").collect()
    assert {r.key for r in got} == {f"k{i}" for i in range(200000) if str(i).startswith("1999")}


def test_url_query(spark, sf):
    want = {(r.page_id, *brute_url(r.url)) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    assert {tuple(r) for r in QUERIES["op7_url_filters"](spark, sf).collect()} == want


# Quality rules


def brute_quality(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen, repeat = Counter(windows), set()
    for i, w in enumerate(windows):
        if seen[w] > 1:
            repeat.update(range(i, i + 5))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 10 or 100 * len(repeat) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeat), failed


MORE = ["a b c d e " * 3, "one two three four five six seven eight nine ten eleven", "x\x1fy\u2028z \x85 w", "same line here\nsame line here\n same line here\n\n\t\n", "🙂 <|> ## é"]


def test_quality_rules(spark):
    texts = ODD + MORE
    got = {r.doc_id: r for r in quality_rules.score(docs_of(spark, texts), lambda d: materialize(d, "q")).collect()}
    for i, t in enumerate(texts):
        assert tuple(got[i])[1:7] == brute_quality(t), t
    assert len(got) == len(texts) + 1
    assert quality_rules.score(docs_of(spark, texts).limit(0), lambda d: materialize(d, "q")).count() == 0


def test_host_verdicts(spark):
    good = "one two three four five six seven eight nine ten eleven twelve"
    data = [(i, "bad", "junk" if i % 10 else good) for i in range(200)] + [(1000 + i, "fine", good if i % 10 else "junk") for i in range(200)] + [(5000, "tiny", "junk"), (5001, None, good)]
    df = spark.createDataFrame(data, "doc_id long, source string, text string")
    got = {r.doc_id: r.kept for r in quality_rules.score(df, lambda d: materialize(d, "q")).collect()}
    assert not any(got[i] for i in range(200)) and all(got[1000 + i] == bool(i % 10) for i in range(200)) and got[5001]
    rates = {r.host: r for r in quality_rules.host_rates(df.withColumn("f", df.text == "junk"), "source", "f").collect()}
    assert rates["tiny"].rate < 1 and abs(rates["bad"].rate - 0.9) < 0.05
    kept = quality_rules.keep_good(df)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {k for k, v in got.items() if v}


def test_quality_query(spark, sf):
    want = {(r.doc_id, *brute_quality(r.text)) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op8_quality_rules"](spark, sf).collect()
    assert {tuple(r)[:7] for r in got} == want and all(r.kept <= (not r.base_failed) for r in got)
