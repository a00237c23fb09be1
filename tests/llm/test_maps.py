"""PII, packing, token files, sharding: against plain Python on small tables."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from periodlens.llm import packing, pii, queries, sharding, tokenfile
from periodlens.llm.tokens import Encoder, vocabulary
from periodlens.session import staging_path

from .helpers import awkward, collected, documents, sample

# ---- personal data

PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def plain(text):
    out = []
    for kind, p in PATTERNS.items():
        for m in p.finditer(text):
            d = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")) or kind == "card" and not (12 <= len(d) <= 19 and luhn(d)) or kind == "phone" and not 9 <= len(d) <= 15:
                continue
            out.append((kind, *m.span()))
    return sorted(out, key=lambda s: (s[1], list(PATTERNS).index(s[0])))


PIECES = st.sampled_from(["a", "b.c", "@", "x@y.z", ".", "-", "1.2.3.4", "300.1.1.1", "255", "4866351201689520", "4866 3512-0168 9520", "+1 (229) 555-4838", "+", "+12", " ", "  ", "9", "0001", "é", "@@", "%", "\n"])


@settings(max_examples=400, deadline=None)
@given(st.lists(PIECES, max_size=14).map("".join))
def test_base_spans_equal_the_patterns(text):
    assert pii.detect(text) == plain(text)


@pytest.mark.parametrize(
    "text,want",
    [
        ("mail bob.42 [at] mail8 [dot] example (dot) com now", [("email", "bob.42 [at] mail8 [dot] example (dot) com")]),
        ("mail bob @ mail8.example.com, not bob @ work", [("email", "bob @ mail8.example.com")]),
        ("write to bob at mail dot example dot com.", [("email", "bob at mail dot example dot com")]),
        ("x bоb＠mail․example.com y", [("email", "bоb＠mail․example.com")]),
        ("call plus one two two nine five five five four eight three eight today", [("phone", "plus one two two nine five five five four eight three eight")]),
        ("host five five dot six three dot one seven eight dot one four two up", [("ip", "five five dot six three dot one seven eight dot one four two")]),
        ("card ４８６６３５１２０１６８９５２０.", [("card", "４８６６３５１２０１６８９５２０")]),
        ("card 4866​3512​0168​9520.", [("card", "4866​3512​0168​9520")]),
        ("he sat at the dot. One two three, go; look at this", []),
    ],
)
def test_disguises_map_back(text, want):
    base, spans = pii.find(text)
    assert base == plain(text)
    assert [(k, text[s:e]) for k, s, e in spans] == want


@pytest.mark.parametrize(
    "text,want",
    [
        ("write to jane at example.com today", [("email", "jane at example.com")]),
        ("host one point two point three point four is up", [("ip", "one point two point three point four")]),
        ("card 4866 3512 0168 952 zero please", [("card", "4866 3512 0168 952 zero")]),
        ("he sat at 5.30 and left at 6.15pm", []),
        ("a host at 10.0.0.1 is up", [("ip", "10.0.0.1")]),
    ],
)
def test_each_disguise_counts_alone(text, want):
    for around in ("{}", "one two — {}"):
        held = around.format(text)
        assert [(k, held[s:e]) for k, s, e in pii.find(held)[1]] == want


def test_base_spans_stay_beside_disguised_ones():
    text = "a@b.example and c [at] d [dot] example; 1.2.3.4"
    base, spans = pii.find(text)
    assert set(base) < set(spans) and len(spans) == 3


@pytest.mark.parametrize(
    "text,want,masked",
    [
        ("call +1 555 123 45 six seven now", [("phone", "+1 555 123 45"), ("phone", "+1 555 123 45 six seven")], "call [PHONE] now"),
        ("to jane@mail.example[.]com now", [("email", "jane@mail.example"), ("email", "jane@mail.example[.]com")], "to [EMAIL] now"),
        ("to 4866351201689520 [at] mail [dot] example now", [("email", "4866351201689520 [at] mail [dot] example"), ("card", "4866351201689520")], "to [EMAIL] now"),
        ("to a@b.example, not [here]", [("email", "a@b.example")], "to [EMAIL], not [here]"),
    ],
)
def test_disguised_spans_that_overlap_base_ones_stay(text, want, masked):
    base, spans = pii.find(text)
    assert base == plain(text) and set(base) <= set(spans)
    assert [(k, text[s:e]) for k, s, e in spans] == want
    assert pii.mask(text, spans) == masked


def test_long_runs_are_linear():
    for text in ("a" * 300_000, "1" * 300_000, "@" * 100_000, "+1" * 100_000, "1." * 100_000, "a@" * 100_000, "one " * 50_000):
        pii.find(text)


def test_pii_query(spark):
    docs = documents(spark, [*awkward(), "x@y.zz 1.2.3.4", "q [at] w [dot] zz"])
    rows = collected(pii.digest(pii.find_pii(docs.withColumn("spans", docs.text))))
    texts = [r["text"] for r in collected(docs)]
    assert len(rows) == len(texts)
    for r, t in zip(rows, texts, strict=True):
        base = plain(t or "")
        text = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(b[0] == k for b in base) for k in pii.KINDS]
    assert rows[-1]["spans"] == "email:0:17"
    masked = collected(pii.mask_pii(docs))
    assert masked[-2]["text"] == "[EMAIL] [IP]" and masked[-2]["n_chars"] == 12 and masked[0]["text"] is None
    assert pii.mask_pii(docs).schema == docs.schema
    assert pii.digest(pii.find_pii(docs.limit(0))).count() == 0


# ---- token ids


@pytest.mark.parametrize("name,kind", [("byte_bpe_50k.json", "byte"), ("word_bpe_49k.json", "word")])
def test_cached_ids_equal_the_library(spark, name, kind):
    e = Encoder(vocabulary(name), kind)
    texts = [t or "" for t in (x if not isinstance(x, tuple) else x[1] for x in awkward(40))]
    texts += ["a   b", " a \n b\n\n  c ", "Don't we'll 'S it's\tb ΑΣ İx é <|endoftext|> z²½ ẞ", "\x1c b\x85c d", "’s don’t ｆｕｌｌ"]
    texts += [r.text for r in sample(spark).limit(60).collect()]
    for t in texts:
        assert np.frombuffer(e.encode(t), e.dtype).tolist() == e.tokenizer.encode(t, add_special_tokens=False).ids, t[:80]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=" \n\t'sdon.,9é²Σ́ \x1c<|>", max_size=25))
def test_cached_ids_of_any_text(text):
    for e in ENCODERS:
        assert np.frombuffer(e.encode(text), e.dtype).tolist() == e.tokenizer.encode(text, add_special_tokens=False).ids


ENCODERS = [Encoder(vocabulary("byte_bpe_50k.json"), "byte"), Encoder(vocabulary("word_bpe_49k.json"), "word")]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=50))
def test_variable_length_code_round_trip(ranks):
    control, data = tokenfile.encode_ranks(np.array(ranks, np.uint32))
    assert len(control) == -(-len(ranks) // 4)
    assert tokenfile.decode_ranks(control, data, len(ranks)).tolist() == ranks


def by_order(docs):
    """Rows as the file set orders them: null ids first, ties in the order of the input."""
    rows = collected(docs)
    return sorted(rows, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0))


@pytest.mark.parametrize("small", [False, True])
def test_token_file(spark, small, monkeypatch):
    docs = documents(spark, awkward()).coalesce(1) if small else sample(spark)
    folder = staging_path(spark, "test-token-file")
    tokenfile.write(spark, docs, folder, vocabulary("byte_bpe_50k.json"), shard_ids=2000)
    got = sorted(collected(tokenfile.digest(spark, folder)), key=lambda r: r["start"])
    e, start = ENCODERS[0], 0
    want = by_order(docs)
    assert len(got) == len(want) and spark.read.parquet(f"{folder}/shards").count() > 3
    for g, w in zip(got, want, strict=True):
        ids = np.array([*e.tokenizer.encode(w["text"] or "", add_special_tokens=False).ids, 2], "<u4")
        assert (g["doc_id"], g["start"], g["n_tokens"], g["ids_crc32"]) == (w["doc_id"], start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    some = tokenfile.read(spark, folder).orderBy("start").first()
    assert len(some.ids) == some.n_tokens


def test_token_file_of_nothing(spark):
    folder = staging_path(spark, "test-token-file")
    tokenfile.write(spark, documents(spark, []), folder, vocabulary("byte_bpe_50k.json"))
    assert tokenfile.digest(spark, folder).count() == 0


# ---- packing


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=80))
def test_best_fit_takes_the_tightest_window(lengths):
    where, offset = packing.best_fit_decreasing(np.array(lengths, np.int64), 64)
    room, want = [], []  # plain best fit
    for n in sorted(lengths, reverse=True):
        fit = [r for r in room if r >= n]
        if fit:
            room.remove(min(fit))
            room.append(min(fit) - n)
        else:
            room.append(64 - n)
        want = room
    used = {}
    for w, o, n in zip(where.tolist(), offset.tolist(), lengths, strict=True):
        used.setdefault(w, []).append((o, n))
    for parts in used.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 64
    assert sorted(64 - sum(n for _, n in p) for p in used.values()) == sorted(want)


def test_pack(spark):
    docs = documents(spark, awkward(900))
    packed = packing.pack(spark, docs, vocabulary("word_bpe_49k.json"), bucket_tokens=20_000)
    rows = collected(packing.digest(packed))
    want = []
    for r in collected(docs):
        ids = np.array([*ENCODERS[1].tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 2], "<u4")
        want += [(r["doc_id"], a, len(ids[a : a + 4096]), zlib.crc32(ids[a : a + 4096].tobytes()), len(ids)) for a in range(0, len(ids), 4096)]
    key = lambda x: (x[0] is None, x[0] or 0, *x[1:])
    assert sorted([(r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in rows], key=key) == sorted(want, key=key)
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 4096
    for s in packing.sequences(packed).collect():
        n = len(s.input_ids)
        assert s.length == sum(x for _, x in by[s.sequence_id]) and (n == 4096 or n == s.length and n & (n - 1) == 0)
    assert packing.digest(packing.pack(spark, docs.limit(0), vocabulary("word_bpe_49k.json"))).count() == 0


def test_padding_is_little(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    total, n = packing.pack(spark, docs, vocabulary("word_bpe_49k.json")).selectExpr("sum(length)", "count(distinct sequence_id)").first()
    assert 1 - total / (4096 * n) < 0.01


# ---- shards


def test_matrix_has_exact_sums():
    counts, sizes = np.array([5, 0, 17, 3, 8]), np.array([11, 11, 11])
    m = sharding.communication_matrix(counts, sizes, 3)
    assert m.sum(1).tolist() == counts.tolist() and m.sum(0).tolist() == sizes.tolist()
    draws = np.array([sharding.communication_matrix(counts, sizes, s)[2, 0] for s in range(600)])
    assert abs(draws.mean() - 17 / 3) < 0.2


@pytest.mark.parametrize("cell_rows", [3, 1 << 13])
def test_shards(spark, cell_rows):
    docs = documents(spark, [*awkward(), *[(i, f"text {i}") for i in range(100)]]).withColumn("shard", documents(spark, []).schema and sharding.F.lit("x"))
    out = sharding.shuffle_to_shards(spark, docs, n_shards=7, chunk_rows=9, cell_rows=cell_rows)
    rows = collected(sharding.digest(out))
    assert len(rows) == 114
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert sorted(by) == list(range(7)) and all(sorted(s) == list(range(len(s))) for s in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    key = lambda x: (x[0] is None, x)
    want = [(r["doc_id"] or -1, len((r["text"] or "").encode()) + 8, zlib.crc32((r["text"] or "").encode())) for r in collected(docs)]
    assert sorted([(r["doc_id"] or -1, r["size"], r["text_crc32"]) for r in rows]) == sorted(want) and key
    again = collected(sharding.digest(sharding.shuffle_to_shards(spark, sample(spark), seed=7)))
    other = collected(sharding.digest(sharding.shuffle_to_shards(spark, sample(spark), seed=8)))
    place = lambda rows: {r["doc_id"]: (r["shard"], r["slot"]) for r in rows}
    assert place(again) != place(other)
    assert place(again) == place(collected(sharding.digest(sharding.shuffle_to_shards(spark, sample(spark), seed=7))))


def test_fewer_rows_than_shards_and_none(spark):
    assert sharding.shuffle_to_shards(spark, documents(spark, ["a", "b"])).count() == 2
    assert sharding.shuffle_to_shards(spark, documents(spark, [])).count() == 0


def test_queries_cover_the_whole_table(spark):
    n = sample(spark).count()
    for name in ("op4_pii_deobfuscation", "op5_ranked_token_file", "op7_hypergeometric_shards", "op8_suffix_decontamination"):
        assert queries.QUERIES[name](spark, "/root/testdata/sf0.001").count() == n


@pytest.mark.parametrize("rows", [200, 37])
def test_shards_by_a_matrix_of_two_levels(spark, monkeypatch, rows):
    monkeypatch.setattr(sharding, "MOST_CHUNKS", 2)
    monkeypatch.setattr(sharding, "GROUP_CHUNKS", 3)
    docs = sample(spark, rows).repartition(5)

    def placed(seed):
        return {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.shuffle_to_shards(spark, stable, n_shards=7, chunk_rows=4, seed=seed).collect()}

    from periodlens.llm.rows import stage

    stable = stage(spark, docs, "docs")
    got = placed(1)
    sizes = [sum(s == k for s, _ in got.values()) for k in range(7)]
    assert len(got) == rows and max(sizes) - min(sizes) <= 1
    assert all(sorted(slot for s, slot in got.values() if s == k) == list(range(sizes[k])) for k in range(7))
    assert placed(1) == got != placed(2)
