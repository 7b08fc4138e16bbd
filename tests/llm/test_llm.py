"""Operators for training data against plain Python, SQL, round trips and held-out rows."""

import hashlib
import os
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerlake.llm import exact, langid, packing, pieces, pii, quality, queries, simhash, suffixes, toxicity, webtext

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
needs_data = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")

ODD = [
    (5, "same  text\twith \n spaces"), (3, "same text with spaces"), (9, None), (8, ""), (8, ""), (None, "lonely"), (11, "x"),
    (12, "word " * 3000), (13, "word " * 3000), (14, "a\x00b   é 😀 " * 20), (15, "Mail ann@x.org or call +1 (017) 555-7713 ok"),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key int, norm string, kind string, id_ string"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, and columns named like the operators' own."""
    return spark.createDataFrame([(i, t, "en", "s", 1, 7, "n", "k", "i") for i, t in ODD], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(5, 1, 0), (3, 1, 0), (12, 0, 1), (12, 0, None)], "doc_id long, quality int, toxic int")


def docs_of(spark, name="documents"):
    return spark.read.parquet(f"{SF_DIR}/{name}.parquet")


# 1: toxicity


def test_label_model_finds_good_voters():
    rng = np.random.default_rng(1)
    truth = rng.random(3000) < 0.2
    good = rng.random(3000) < np.where(truth, 0.7, 0.01)
    also = rng.random(3000) < np.where(truth, 0.6, 0.02)
    noise = rng.random(3000) < 0.1
    label = np.where(rng.random(3000) < 0.05, ~truth, truth)
    votes = np.stack([good, also, noise, label], axis=1).astype(float)
    posterior, toxic, clean, shares = toxicity.label_model(votes, start=np.where(good, 0.9, 0.05))
    assert np.mean((posterior > 0.5) == truth) > np.mean(label == truth)  # better than the noisy label alone
    assert toxic[0] > 0.6 and clean[0] < 0.05 and abs(toxic[2] - clean[2]) < 0.1


def test_twin_voters_share_their_weight():
    rng = np.random.default_rng(2)
    truth = rng.random(2000) < 0.3
    one = (rng.random(2000) < np.where(truth, 0.7, 0.1)).astype(float)
    other = (rng.random(2000) < np.where(truth, 0.7, 0.1)).astype(float)
    shares = toxicity.label_model(np.stack([one, one, other], axis=1))[3]
    assert shares[0] < 0.7 < shares[2]


def test_toxicity_odd_rows(spark, odd, none, labels):
    model = toxicity.fit(odd, labels)
    rows = toxicity.score(odd, model).collect()
    assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.accepted(odd, model).columns == odd.columns
    empty = toxicity.fit(none, labels.limit(0))
    assert toxicity.score(none, empty).count() == 0


@needs_data
def test_toxicity_held_out(spark):
    got = queries.op1_toxicity(spark, SF_DIR).join(docs_of(spark, "labels"), "doc_id").where("held_out").toPandas()
    insults = {w for ws in toxicity.LEXICONS.values() for w in ws}
    texts = {r["doc_id"]: r["text"] for r in docs_of(spark).collect()}
    hits = [bool(insults & set(re.findall(r"[^\W\d_]+", texts[i].lower()))) for i in got["doc_id"]]
    assert all(p == 1 for p, h in zip(got["predicted"], hits, strict=True) if h)
    assert got[got["toxic"] == 0]["predicted"].mean() < 0.02


# 2: SimHash


def slow_fingerprint(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[k : k + size]) for k in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_groups(rows, size=4, budget=4):
    prints = [slow_fingerprint(t, size) for _, t in rows]
    up = list(range(len(rows)))

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= budget:
                up[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        least.setdefault(root(k), []).append(i)
    smallest = {r: min((i for i in ids if i is not None), default=None) for r, ids in least.items()}
    return sorted(((i, f"{p:016x}", smallest[root(k)]) for k, ((i, _), p) in enumerate(zip(rows, prints, strict=True))), key=str)


def test_simhash_odd_rows(spark, odd, none):
    got = sorted((tuple(r) for r in simhash.near_groups(odd).collect()), key=str)
    assert got == slow_groups(ODD)
    assert simhash.near_groups(none).count() == 0


@needs_data
def test_simhash_whole_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in docs_of(spark).select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in queries.op2_simhash(spark, SF_DIR).collect()), key=str) == slow_groups(rows)


def test_links_connect_what_is_near(spark):
    rng = random.Random(3)
    seeds = [rng.getrandbits(64) for _ in range(6)]
    prints = sorted({s ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 6))) for s in seeds for _ in range(60)})
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    rows = spark.createDataFrame([(s,) for s in signed], "fp long")
    for chunk in (4096, 7):  # 7: every block group is dealt out in chunks
        root = {r["node"]: r["root"] for r in simhash.components(simhash.links(rows, 4, chunk)).collect()}
        up = {s: s for s in signed}

        def find(x, up=up):
            while up[x] != x:
                x = up[x]
            return x

        for a, p in zip(signed, prints, strict=True):
            for b, q in zip(signed, prints, strict=True):
                if (p ^ q).bit_count() <= 4:
                    x, y = find(a), find(b)
                    up[max(x, y)] = min(x, y)
        assert {s: root.get(s, s) for s in signed} == {s: find(s) for s in signed}


# 3: suffixes


def slow_repeats(rows, length=100):
    seen, out = set(), []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            s = b[k : k + length]
            if s in seen:
                gone[k : k + length] = b"\1" * length
            seen.add(s)
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        runs = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def passages(seed, n=60):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(300)]
    shared = [" ".join(rng.choice(words) for _ in range(rng.randint(5, 60))) for _ in range(12)]
    pick = [lambda: rng.choice(shared), lambda: rng.choice(shared)[: rng.randint(1, 300)], lambda: " ".join(rng.choice(words) for _ in range(40)), lambda: "ab " * rng.randint(1, 80)]
    return [(k, " ".join(rng.choice(pick)() for _ in range(rng.randint(0, 6)))) for k in range(n)]


def test_repeats_against_plain_python(spark, none):
    rows = passages(4) + [(1000, None), (1001, ""), (None, passages(4)[3][1])]
    got = suffixes.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    assert sorted((tuple(r) for r in got.collect()), key=str) == slow_repeats(rows)
    assert suffixes.remove_repeats(none).count() == 0


def test_long_texts_in_blocks(monkeypatch):
    monkeypatch.setattr(suffixes, "BLOCK", 700)
    suffixes._family.cache_clear()
    rows = [(k, t.encode()) for k, t in passages(5)]
    seen = Counter()
    for _, _, ids, start, strings, _ in suffixes.spans(iter(rows), 100, 40):
        for i, s, n in zip(ids.tolist(), start.tolist(), strings.tolist(), strict=True):
            seen.update((i, k) for k in range(s, s + n))
    suffixes._family.cache_clear()
    assert seen == Counter((i, k) for i, t in rows for k in range(len(t) - 99))


@needs_data
def test_repeats_whole_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in docs_of(spark).select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in queries.op3_suffixes(spark, SF_DIR).collect()), key=str) == slow_repeats(rows)


# 4: web pages


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""), ("", ""), ("<", "<"), ("plain &amp; simple", "plain & simple"), ("<p>a<b>b</b> c", "ab c"),
        ("<div><p>x &lt; y</p><ul><li>1<li>2</ul></div>", "x < y\n1\n2"), ("<script>var x='<p>no</p>'</script>", ""),
        ("<body><nav><a href=/>menu</a></nav><article><h1>T</h1><p>one two three</p><p>four</p></article><footer>foot</footer></body>", "T\none two three\nfour"),
        ("<main><p>text of the main part</p><p>more</p><div class='comments'><p>first!</p></div><form><p>send</p></form></main>", "text of the main part\nmore"),
        ("<p title='a>b'>kept  as \n one</p><aside>no</aside><p>two</p>", "kept as one\ntwo"),
        ("<p>fish &am<b>p;</b> chips</p>", "fish &amp; chips"), ("<p>t</p><script>" + "</script " * 50_000, "t"),
        ("<div>" * 50_000 + "deep", "deep"), ("<p>t</p>" + "<a" * 50_000, "t\n" + "<a" * 50_000),
    ],
)
def test_main_text(page, text):
    assert webtext.main_text(page) == text


@needs_data
def test_pages(spark):
    pages = docs_of(spark, "pages")
    got = {r["page_id"]: r["text"] for r in queries.op4_webtext(spark, SF_DIR).collect()}
    import html

    for r in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        blocks = [re.sub(r"[\x20\x09-\x0D]+", " ", html.unescape(re.sub(r"<[^>]+>", "", x))).strip(" ") for x in re.split(r"</?(?:p|h1|br)\b[^>]*>", inner)]
        assert got[r["page_id"]] == "\n".join(b for b in blocks if b)


# 5: exact


def test_directory_splits_full_buckets():
    assert set(exact.directory({}, 10, 4)) == {0}
    slots = exact.directory({0: 8, 1: 8, 8: 5}, 10, 4)
    assert slots[0] != slots[1] and slots[8] == slots[15] and sorted(set(slots)) == list(range(len(set(slots))))


def test_full_slots_double_on_their_own(spark):
    once = spark.createDataFrame([(0, 1 << 40, 6), (0, 1 << 41, 6), (0, 1 << 61, 6), (1, 1 << 62, 50), (2, -1, 6)], "slot int, key long, n_bytes long")
    bits = exact.doublings(once, {0: 18, 1: 50, 2: 6}, capacity=10, deepest=2)
    # keys 2**40 and 2**41 part at bit 22 from the left; a single key is never split; a slot that fits is left alone
    assert bits[0] == 64 - 2 - 41 and bits[2] == bits[3] == 0 and 1 <= bits[1] < 10


def test_index_decides(spark, monkeypatch):
    """Rows find their group through the directory: without its buckets none does."""
    docs = spark.createDataFrame([(k, "same") for k in range(8)], "doc_id long, text string").repartition(4)
    assert {r["group_size"] for r in exact.exact_groups(docs).collect()} == {8}
    monkeypatch.setattr(exact, "_by_slot", lambda values: F.lit(None).cast("int"))
    assert exact.exact_groups(docs).count() == 0


def test_owners_shuffle_no_text_again(spark, odd):
    """The aggregate in a bucket's task needs no exchange of its own."""
    df = spark.range(10).selectExpr("id % 3 as bucket", "id as key", "cast(id as string) as norm").repartition("bucket").groupBy("bucket", "key", "norm").count()
    assert df._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_exact_odd_rows(spark, odd, none):
    got = sorted((tuple(r) for r in exact.exact_groups(odd, capacity=8).collect()), key=str)
    norm = {k: re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for k, (_, t) in enumerate(ODD)}
    want = []
    for k, (i, _) in enumerate(ODD):
        same = [ODD[j][0] for j in norm if norm[j] == norm[k]]
        keep = None if None in same else min(same)
        want.append((i, keep, len(same), i == keep, hashlib.sha256(norm[k].encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert exact.exact_groups(none).count() == 0


@needs_data
def test_exact_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF_DIR}/documents.parquet'")
    want = con.execute(queries.ORACLE["op5_exact"]).fetchall()
    got = [tuple(r) for r in queries.op5_exact(spark, SF_DIR).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()]
    assert sorted(got) == sorted(want)


# 6: quality


def slow_base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    often = Counter(windows)
    repeated = {k + j for k, w in enumerate(windows) if often[w] > 1 for j in range(3)}
    failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated), failed


def test_quality_base(spark, odd, none):
    rng = random.Random(6)
    more = [(100 + k, " ".join(rng.choice(["a", "b", "c#", "D\n", "é"]) for _ in range(rng.randint(0, 300)))) for k in range(20)]
    wide = [(200, " ".join(f"{a} {b} x" for a in range(30) for b in range(10)) * 2)]  # more repeated windows than are looked up
    rows = odd.union(spark.createDataFrame([(i, t, "en", "s", 1, 7, "n", "k", "i") for i, t in more + wide], SCHEMA))
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    got = sorted(((r["doc_id"], *[r[c] for c in base]) for r in quality.quality(rows).collect()), key=str)
    assert got == sorted(((i, *slow_base(t)) for i, t in ODD + more + wide), key=str)
    assert quality.quality(none).count() == 0


def test_quality_learns_other_languages(spark):
    """Words of a language without fixed ones are counted; a language with too few rows is judged by the base rules."""
    rng = random.Random(9)
    filler = ["".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(3)) for _ in range(300)]
    common = "il di che e la un per in non si con da come questo sono del".split()

    def clean():
        return " ".join(rng.choice(common if rng.random() < 0.4 else filler) for _ in range(200))

    rows = [(k, clean(), "it") for k in range(80)] + [(100, clean(), "xx"), (101, " ".join(rng.choice(filler).upper() for _ in range(200)), "it"), (102, None, "it"), (103, clean(), None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert set(common) <= set(quality.common_words(docs)["it"]) and set(quality.common_words(docs)) == {*quality.COMMON, "it"}
    kept = {r["doc_id"]: r["kept"] for r in quality.quality(docs).collect()}
    assert all(kept[k] for k in range(80)) and kept[100] and kept[103] and not kept[101] and not kept[102]


@needs_data
def test_quality_keeps_clean_rows(spark):
    got = queries.op6_quality(spark, SF_DIR).join(docs_of(spark, "labels"), "doc_id").where("not base_failed")
    shares = {r["quality"]: r["kept"] for r in got.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert shares[1] > 0.97 and shares.get(0, 0) < 0.2


# 7: packing


def slow_best_fit(lengths, size):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [(r, k) for k, r in enumerate(rooms) if r >= n]
        if fits:
            rooms[min(fits)[1]] -= n
        else:
            rooms.append(size - n)
    return sorted(rooms)


def test_plan_is_best_fit_decreasing():
    rng = random.Random(7)
    for _ in range(60):
        size = rng.choice([10, 37, 1024])
        lengths = [rng.randint(1, size) for _ in range(rng.randint(0, 200))]
        made = packing.plan(Counter(lengths), size)
        assert sorted(size - sum(n * k for n, k in c) for m, c in made for _ in range(m)) == slow_best_fit(lengths, size)


def test_packing(spark, odd, none):
    from tokenizers import Tokenizer

    path = queries.tokenizer_file("byte_bpe_50k.json")
    rows = packing.pack_documents(odd, path, size=64).toPandas()
    engine = Tokenizer.from_file(path)
    want = []
    for i, t in ODD:
        ids = engine.encode(t or "", add_special_tokens=False).ids + [2]
        first = len(ids) % 64 or min(64, len(ids))
        cuts = [0, *range(first, len(ids), 64)]
        want += [(i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, [*cuts[1:], len(ids)], strict=True))]
    got = [(None if x != x or x is None else int(x), *map(int, y)) for x, *y in rows[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False)]
    assert sorted(got, key=str) == sorted(want, key=str)
    for _, own in rows.sort_values("offset").groupby("sequence_id"):
        assert own["offset"].tolist() == [0, *own["length"].cumsum().tolist()[:-1]] and own["length"].sum() <= 64
    assert rows["sequence_id"].nunique() == len(slow_best_fit(rows["length"], 64))
    assert packing.pack_documents(none, path).count() == 0


def test_encoder_takes_every_text(spark):
    """Texts that the fast engine refuses, special tokens in the text, and files it does not fit."""
    import json

    from tokenizers import Tokenizer

    path = queries.tokenizer_file("byte_bpe_50k.json")
    engine, encode = Tokenizer.from_file(path), packing.encoder(path)
    for text in (" " * 1_000_000, "x" + "\n" * 1_000_000, "a<|endoftext|>b", "", " a  b\t\r\n c²½Ⅷ 한국어 عربى"):
        assert encode(text).tolist() == engine.encode(text, add_special_tokens=False).ids
    spec = json.loads(engine.to_str())
    assert packing.plain(spec)
    assert not packing.plain(spec | {"normalizer": {"type": "Lowercase"}})
    assert not packing.plain(spec | {"model": spec["model"] | {"merges": spec["model"]["merges"][::-1]}})


@needs_data
def test_packing_whole_table(spark):
    """Pieces of every document equal the tokenizer's; as many sequences as slow best fit makes."""
    from tokenizers import Tokenizer

    engine = Tokenizer.from_file(queries.tokenizer_file("byte_bpe_50k.json"))
    rows = queries.op7_packing(spark, SF_DIR).toPandas()
    want = []
    for r in docs_of(spark).collect():
        ids = engine.encode(r["text"] or "", add_special_tokens=False).ids + [2]
        want += [(r["doc_id"], k, a, n, zlib.crc32(np.array(ids[a : a + n], "<u4").tobytes())) for k, (a, n) in enumerate(packing.cuts(len(ids)))]
    got = rows[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False)
    assert sorted(map(tuple, got)) == sorted(want)
    assert rows["sequence_id"].nunique() == len(slow_best_fit(rows["length"], 1024))


# 8: SentencePiece


def test_pieces_match_the_library(spark, odd, none):
    path = queries.tokenizer_file("piece_bpe_32k.model")
    assert pieces.parity(odd, path).count() == 0
    ids = pieces.encode(odd.where("doc_id is not null").dropDuplicates(["doc_id"]), path)
    back = {r["doc_id"]: r["text"] for r in pieces.decode(ids, path).collect()}
    assert back == {i: t or "" for i, t in ODD if i is not None}
    assert pieces.digests(none, path).count() == 0


@needs_data
def test_pieces_whole_table(spark):
    path = queries.tokenizer_file("piece_bpe_32k.model")
    assert pieces.parity(docs_of(spark), path).count() == 0
    assert queries.op8_pieces(spark, SF_DIR).where("not round_trip").count() == 0


# 9: language


@needs_data
def test_language_held_out(spark):
    got = queries.op9_language(spark, SF_DIR).join(docs_of(spark).select("doc_id", "lang"), "doc_id").where("held_out")
    assert got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.93


def test_language_odd_rows(spark, odd, none):
    model = langid.fit(odd)
    rows = {r["doc_id"]: r for r in langid.predict(odd, model).collect()}
    assert rows[9]["lang_pred"] == rows[8]["lang_pred"] == "und" and rows[15]["lang_pred"] == "en"
    assert langid.predict(odd, langid.fit(none)).where("lang_pred <> 'und'").count() == 0


@pytest.mark.parametrize("text", ["²", "½ ⅓", "Ⅷ ①", "123 _ !", "\u0301", " \n"])
def test_no_letter_no_language(spark, odd, text):
    assert langid.classify(langid.fit(odd), text) == ("und", 0.0, False)


# 10: personal data


@pytest.mark.parametrize(
    ("text", "spans"),
    [
        ("a.b@c.de,x", [("email", 0, 8)]), ("1.2.3.4.5 and 300.1.1.1", [("ip", 0, 7)]), ("4111 1111-1111 1111", [("card", 0, 19)]),
        ("é +1 (017) 555-7713.", [("phone", 2, 19)]), ("+12345678", []), ("4111111111111112", []), ("no", []),
    ],
)
def test_base_spans(text, spans):
    assert [(k, a, b) for a, b, k in pii.base_spans(text)] == spans


def test_base_spans_against_the_patterns():
    """The contract's patterns as they stand, and texts on which they would take the square of the length."""
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    ip = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    rng = random.Random(10)
    for _ in range(20_000):
        text = "".join(rng.choice("aZ0.1@@-_+ 9(é.2%") for _ in range(rng.randint(0, 40)))
        got = pii.base_spans(text)
        assert [(a, b) for a, b, k in got if k == "email"] == [m.span() for m in email.finditer(text)]
        assert [(a, b) for a, b, k in got if k == "ip"] == [m.span() for m in ip.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    assert pii.base_spans("1" * 1_000_000) == pii.base_spans("a" * 1_000_000 + "@") == pii.base_spans("a@" * 300_000) == []
    assert pii.base_spans("a" * 1_000_000 + "@x.org") == [(0, 1_000_006, "email")]


def test_field_adds_and_leaves_alone():
    field = pii.train([])
    found = lambda t: [t[a:b] for a, b, _ in pii.all_spans(t, field)[1]]
    assert found('token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" x') == ["24be64439e3e49cf46b2d7c90f3602a3d0b907ff"]
    assert found("call (017) 555-7713 now") == ["(017) 555-7713"]
    assert found("in 2024, version 2.0 of 12345 pieces") == []
    assert pii.redact("mail ann@x.org, now", field) == "mail <email>, now"


def test_marginals_sum_over_paths():
    spans, scores = [(0, 1, 0, 0), (1, 2, 0, 0), (0, 2, 0, 0)], np.log(np.array([[2.0], [3.0], [5.0]]))
    # paths: none 1, first 2, second 3, both 6, whole 5: 17
    assert np.allclose(pii.Field.marginals(2, spans, scores)[:, 0], [8 / 17, 9 / 17, 5 / 17])


def test_pii_odd_rows(spark, odd, none):
    field = pii.fit(odd)
    rows = {r["doc_id"]: r for r in pii.find(odd, field).collect()}
    assert (rows[15]["n_email"], rows[15]["n_phone"], rows[9]["spans"]) == (1, 1, "")
    assert rows[15]["spans"] == "email:5:14,phone:23:40"
    assert rows[15]["base_sha256"] == hashlib.sha256(b"email:5:14,phone:23:40").hexdigest()
    masked = pii.redacted(odd, field)
    assert masked.columns == odd.columns and masked.where("doc_id = 9").first()["text"] is None
    assert pii.find(none, pii.fit(none)).count() == 0


# pipeline


@needs_data
def test_pipeline(spark):
    docs = docs_of(spark)
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, stage(spark, kept, SF_DIR).cache()
        assert kept.columns == docs.columns, name
        rows = {r["doc_id"]: r["text"] for r in kept.collect()}
        was = {r["doc_id"]: r["text"] for r in before.collect()}
        assert set(rows) <= set(was) and len(rows) == kept.count()
        if name == "exact dedup":
            assert len({re.sub(r"[\x20\x09-\x0D]+", " ", t) for t in rows.values()}) == len(rows)
        if name == "simhash near-dedup":
            assert set(rows) == {c for _, _, c in slow_groups(list(was.items()))}
        if name == "pii":
            assert set(rows) == set(was) and not any(pii.BASE["email"].search(t) for t in rows.values())
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, SF_DIR)
    assert {r[0] for r in packed.select("doc_id").distinct().collect()} == set(rows)
    assert corpus_pipeline.run(spark, SF_DIR).count() == packed.count()


@pytest.mark.parametrize("stage", range(4))
def test_stages_take_odd_and_empty_tables(spark, odd, none, stage, tmp_path):
    (tmp_path / "sf").mkdir()
    spark.createDataFrame([(5, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/sf/labels.parquet")
    step = corpus_pipeline.STAGES[stage][1]
    assert step(spark, odd, f"{tmp_path}/sf").columns == odd.columns
    assert step(spark, odd, f"{tmp_path}/sf").count() > 0
    assert step(spark, none, f"{tmp_path}/sf").count() == 0


def test_stages_tell_rows_apart_by_text(spark):
    """An id on two texts, a copy under a smaller and a larger id, and rows that repeat everything."""
    rows = [(5, "A a", "x"), (3, "B b", "x"), (5, "B  b", "x"), (7, "c", "y"), (7, "c", "x"), (None, "B b", "x"), (None, "d", "x"), (None, "d", "x")]
    docs = spark.createDataFrame([(i, t, k, 1, "") for i, t, k in rows], "doc_id long, text string, text_sha256 string, kept_id_ int, fp string")
    once = corpus_pipeline.exact_stage(spark, docs, "")
    assert once.columns == docs.columns
    assert sorted(((r[0], r[1], r[2]) for r in once.collect()), key=str) == sorted([(5, "A a", "x"), (None, "B b", "x"), (7, "c", "x"), (None, "d", "x")], key=str)
    words = [f"w{k}" for k in range(400)]
    near = [(5, " ".join(words)), (5, "quite another text of few words"), (2, " ".join([*words[:399], "new"])), (9, " ".join([*words, "end"]))]
    docs = spark.createDataFrame([(i, t, 1) for i, t in near], "doc_id long, text string, fp int")
    got = corpus_pipeline.near_stage(spark, docs, "")
    groups = {}
    prints = [simhash.fingerprint(t) for _, t in near]
    for k, p in enumerate(prints):
        for j in range(k + 1):  # four rows: links by hand
            if bin(p ^ prints[j]).count("1") <= 4:
                groups[k] = groups.get(j, j)
                break
    assert got.columns == docs.columns and groups[1] == 1
    want = sorted(min((near[k] for k, g in groups.items() if g == group), key=lambda r: r[0]) for group in set(groups.values()))
    assert sorted((r["doc_id"], r["text"]) for r in got.collect()) == want


def test_em_keeps_languages_apart():
    """Two groups of toxic rows whose voters never meet: silence of one group's voters is no vote."""
    rng = np.random.default_rng(4)
    n = 4000
    group, truth = rng.integers(0, 2, n), rng.random(n) < 0.1
    voters = np.stack([(truth & (group == g)) * (rng.random(n) < 0.6) for g in (0, 0, 0, 1)], axis=1)
    label = np.where(rng.random(n) < 0.03, ~truth, truth)
    votes = np.column_stack([voters, label]).astype(float)
    posterior = toxicity.label_model(votes, start=np.where(label, 0.9, 0.02), label_share=float(label.mean()))[0]
    assert np.mean((posterior > 0.5)[voters[:, 3] > 0]) > 0.99 and np.mean((posterior > 0.5)[~truth & ~label]) < 0.01


def test_classifier_reaches_beyond_the_lists(spark):
    """Invented insults with many endings, in a language without a list: new endings of held-out rows are found."""
    rng = random.Random(6)
    syllables = ["ta", "mo", "ri", "en", "lu", "ke"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    rows, marks = [], []
    for i in range(3000):
        bad = rng.random() < 0.12
        words = [word() for _ in range(40)] + ["zorb" + word() for _ in range(4 if bad else 0)]
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        marks.append((i, int(bad)))
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, toxic int")
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()}
    held = [(i, t) for i, t in marks if zlib.crc32(str(i).encode()) % 3 == 1]
    assert sum(got[i] == t for i, t in held) > 0.99 * len(held)
