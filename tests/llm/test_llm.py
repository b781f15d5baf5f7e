"""The ten operators against brute force, on odd rows and on the whole documents table."""

import math
import random
import struct
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402
import public_tokenizers  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from harrier.llm import bpe, chat, fingerprint, jaccard, language, licences, packing, quality, queries, sharding, substring  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node long, part int, th string, marks int"
ALL = queries.queries()


def vocabulary():
    rng = random.Random(3)
    return ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 7))) for _ in range(400)]


def odd_rows():
    """Nulls, empty and long texts, repeated rows, exact and near copies, shared passages, odd white space."""
    rng, v = random.Random(5), vocabulary()
    some = lambda n: " ".join(rng.choice(v) for _ in range(n))
    base, shared = some(120), some(60)
    texts = [None, "", "   \n\t", "one", "one two three", "Ünïcode   wörd x é \U0001f600 <|endoftext|> x", some(30_000), "a " * 4000, base, base.upper()]
    for _ in range(30):
        w = base.split()
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = rng.choice(v)
        texts.append(" ".join(w))
    texts += [some(20) + " " + shared + "\n" + some(25) for _ in range(10)] + [some(200) for _ in range(20)] + [shared[:200] + "  \x0b " + shared[:200]]
    rows = [(i * 3, t) for i, t in enumerate(texts)]
    return rows + [(24, base), (24, base)]


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "en" if d and d % 2 else None, None, len(t or ""), 1, 2, "x", 3) for d, t in rows], SCHEMA).repartition(7)


@pytest.fixture(scope="session")
def odd(spark):
    return frame(spark, odd_rows()).cache()


@pytest.fixture(scope="session")
def whole(spark, sf_dir):
    return [(r[0], r[1]) for r in queries.table(spark, sf_dir, "documents").select("doc_id", "text").collect()]


def got(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


def with_null_id():
    rows = odd_rows()
    return [*rows, (None, rows[9][1]), (None, None)]


def test_substring_odd(spark):
    rows = with_null_id()
    assert got(substring.repeats(frame(spark, rows)), "doc_id", "n_words", "n_removed", "kept_sha256") == brute.repeats(rows)


def test_substring_whole(spark, sf_dir, whole):
    assert got(ALL["op5_substring_dedup"](spark, sf_dir), "doc_id", "n_words", "n_removed", "kept_sha256") == brute.repeats(whole)


def test_jaccard_odd(spark):
    rows = with_null_id()
    assert got(jaccard.near_duplicates(frame(spark, rows)), "doc_id", "n_shingles", "component_id") == brute.components(rows)


def test_jaccard_chain_and_short(spark):
    """Chains, where the links of a component are few, and sets near the threshold."""
    rng, v = random.Random(9), vocabulary()
    w = [rng.choice(v) for _ in range(60)]
    rows = []
    for i in range(120):
        rows.append((i, " ".join(w)))
        w = w[2:] + [rng.choice(v) for _ in range(2)]
    for i in range(200, 260):
        rows.append((i, " ".join(rng.choice("ab") for _ in range(rng.randint(1, 7)))))
    assert got(jaccard.near_duplicates(frame(spark, rows)), "doc_id", "n_shingles", "component_id") == brute.components(rows)


def test_jaccard_long_lists(spark, monkeypatch):
    """Lists of hot tokens, split by salts, give the same components."""
    monkeypatch.setattr(jaccard, "LONG", 4)
    rows = with_null_id()
    docs = frame(spark, rows).coalesce(1)
    assert got(jaccard.near_duplicates(docs), "doc_id", "n_shingles", "component_id") == brute.components(rows)


def test_jaccard_least_need(spark):
    """No size within a block's range needs fewer shared tokens than the bound, from sizes and prefixes counted anew."""
    behind = {n: -(-75 * n // 100) - 1 for n in range(1, 140)}
    rows = [(n, low, low + wide) for n in range(1, 100) for low in range(-(-75 * n // 100), n * 100 // 75 + 1) for wide in range(0, 7) if low + wide <= n * 100 // 75]
    found = spark.createDataFrame(rows, "n long, low long, high long").select("n", "low", "high", jaccard._least_need(F.col("n"), F.col("low"), F.col("high"), 75).alias("need")).collect()
    need = lambda x, y: -(-75 * (x + y) // 175) - max(behind[x], behind[y])
    least = {(n, low, high): min(need(n, y) for y in range(low, high + 1)) for n, low, high in rows}
    assert least[26, 26, 28] == 3
    assert all(least[r[0], r[1], r[2]] - 1 <= r["need"] <= least[r[0], r[1], r[2]] for r in found) and len(found) == len(rows)


def test_jaccard_whole(spark, sf_dir, whole):
    assert got(ALL["op7_jaccard_join"](spark, sf_dir), "doc_id", "n_shingles", "component_id") == brute.components(whole)


def hot_rows():
    """A thousand rows without an id and with one text, and some others."""
    rows = odd_rows()
    return rows + [(None, rows[8][1])] * 1000 + [(None, "of all " * 3)]


def test_repeated_rows(spark):
    rows = hot_rows()
    assert got(substring.repeats(frame(spark, rows)), "doc_id", "n_words", "n_removed", "kept_sha256") == brute.repeats(rows)
    assert got(jaccard.near_duplicates(frame(spark, rows)), "doc_id", "n_shingles", "component_id") == brute.components(rows)


def test_keep_one_repeated_id(spark):
    """An id held by a near copy and by a text of its own; null ids."""
    base = odd_rows()[8][1]
    near, other = base + " more", "quite another text of seven words"
    rows = [(3, base), (5, near), (5, other), (5, other), (None, base), (None, "a sixth one of six words"), (7, None), (8, "")]
    kept = [tuple(r) for r in jaccard.keep_one(frame(spark, rows)).select("doc_id", "text").collect()]
    assert sorted(kept, key=repr) == sorted([(3, base), (5, other), (None, "a sixth one of six words"), (7, None), (8, "")], key=repr)


def test_clashing_columns(spark):
    """Columns named as the operators' own ones come through."""
    names = ["th", "marks", "m_id", "m_th", "row", "key", "kept", "label", "held", "node", "part", "comp", "places", "doc", "one", "none", "at"]
    rows = odd_rows()
    docs = frame(spark, rows).drop("node", "part", "th", "marks").select("*", *[F.concat(F.lit(n), "doc_id").alias(n) for n in names])
    for made in (substring.remove(docs), jaccard.keep_one(docs), quality.keep(docs, None), language.keep(docs, language.fit(docs))):
        assert made.columns == docs.columns
        assert all(r[n] == f"{n}{r['doc_id']}" for r in made.collect() for n in names)
    for op in (chat.format_conversations(docs.withColumn("conv_id", F.col("doc_id")).withColumn("turn", F.lit(1)).withColumn("role", F.lit("assistant"))), licences.scan(docs), sharding.shard(docs), fingerprint.edited_likeness(docs), packing.tokenised(docs, public_tokenizers.path("word_bpe_49k.json"))):
        assert op.count() >= 1


def test_keep_one(spark, odd):
    kept = jaccard.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for d, _, c in brute.components(odd_rows()) if d == c})


def test_bpe(spark, odd, sf_dir, whole):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tok.no_truncation()
    tok.no_padding()

    def told(rows):
        ids = [tok.encode(t or "", add_special_tokens=False).ids for _, t in rows]
        return sorted(((d, len(x), brute.sha(",".join(map(str, x))), brute.sha(tok.decode(x, skip_special_tokens=False))) for (d, _), x in zip(rows, ids, strict=True)), key=repr)

    names = ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert got(ALL["op3_bpe"](spark, sf_dir), *names) == told(whole)
    path = public_tokenizers.path("byte_bpe_50k.json")
    coded = bpe.decode(bpe.encode(odd, path), path)
    assert sorted((r["doc_id"], tuple(r["ids"]), r["decoded"]) for r in coded.collect()) == sorted((d, tuple(i := tok.encode(t or "", add_special_tokens=False).ids), tok.decode(i, skip_special_tokens=False)) for d, t in odd_rows())


def packed_right(found, docs):
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tok.no_truncation()
    tok.no_padding()
    ids = [(d, tok.encode(t or "", add_special_tokens=False).ids + [1]) for d, t in docs]
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in found:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append(r)
    assert sum(r["length"] for r in found) == sum(len(x) for _, x in ids)
    many = Counter(d for d, _ in ids)
    for d, x in ids:
        if many[d] > 1:
            continue
        at = 0
        for r in sorted(by_doc[d], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(x)
            assert r["ids_crc32"] == zlib.crc32(struct.pack(f"<{r['length']}I", *x[at : at + r["length"]]))
            at += r["length"]
        assert at == len(x)
    for rows in by_seq.values():
        at = 0
        for r in sorted(rows, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= packing.CAPACITY
    return sum(r["length"] for r in found) / (packing.CAPACITY * len(by_seq))


def every_letter():
    return [chr(i) for i in range(1, 0x20000) if not 0xD800 <= i <= 0xDFFF]


def library(name):
    tok = Tokenizer.from_file(public_tokenizers.path(name))
    tok.no_truncation()
    tok.no_padding()
    return tok


def test_bpe_every_code_point():
    texts = [f"a{c}'s {c}1{c}" for c in every_letter()]
    coder = bpe.load(public_tokenizers.path("byte_bpe_50k.json"))
    told = library("byte_bpe_50k.json").encode_batch_fast(texts, add_special_tokens=False)
    assert [t for t, e in zip(texts, told, strict=True) if coder.encode(t).tolist() != e.ids] == []


def test_word_ids_every_code_point():
    texts = [f"{c}! x{c}. TAT{c}L{c};" for c in every_letter()]
    coder = packing.word_ids(public_tokenizers.path("word_bpe_49k.json"))
    told = library("word_bpe_49k.json").encode_batch_fast(texts, add_special_tokens=False)
    assert [t for t, e in zip(texts, told, strict=True) if coder(t.encode()) != struct.pack(f"<{len(e.ids)}I", *e.ids)] == []


def test_packing(spark, odd, sf_dir, whole):
    assert packed_right(ALL["op4_harmonic_packing"](spark, sf_dir).collect(), whole) > 0.97
    packed_right(packing.pack(packing.tokenised(odd, public_tokenizers.path("word_bpe_49k.json")), 3).collect(), odd_rows())


def test_quality(spark, odd, sf_dir, whole):
    names = ("doc_id", *quality.COUNTS)
    assert got(ALL["op10_quality_rules"](spark, sf_dir), *names) == sorted(((d, *brute.quality_counts(t)) for d, t in whole), key=repr)
    assert got(quality.score(odd, None), *names) == sorted(((d, *brute.quality_counts(t)) for d, t in odd_rows()), key=repr)


def test_quality_trees_follow_labels(spark, sf_dir):
    scored = ALL["op10_quality_rules"](spark, sf_dir).join(queries.table(spark, sf_dir, "labels"), "doc_id")
    right = scored.where("not base_failed").agg(F.avg(((F.col("score") >= 0.5) == (F.col("quality") > 0)).cast("int"))).first()[0]
    assert right > 0.85
    assert scored.where("base_failed and kept").count() == 0


def test_trees_are_monotonic():
    import numpy as np

    rng = np.random.default_rng(1)
    x = rng.random((600, 2))
    trees = quality.fit_trees(x, ((x[:, 0] + 0.3 * rng.random(600) < 0.6) | (x[:, 1] > 0.9)).astype(float), [-1, 0])
    line = np.stack([np.linspace(0, 1, 200), np.full(200, 0.4)], axis=1)
    assert (np.diff(trees.margin(line)) <= 1e-12).all()


def test_language(spark, odd, sf_dir):
    found = ALL["op1_language_id"](spark, sf_dir).join(queries.table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), "doc_id")
    held = found.where("held_out and lang is not null and length(text) > 100")
    assert held.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.95
    assert {r["lang_pred"] for r in language.predict(odd.where("text is null or trim(text) = ''"), language.fit(odd)).collect()} == {"und"}
    assert language.predict(odd, language.fit(odd.limit(0))).where("lang_pred <> 'und'").isEmpty()


def test_language_brute(spark, sf_dir):
    """Every prediction and score from counts in dicts of whole n-grams' buckets, in plain integers."""
    docs = queries.table(spark, sf_dir, "documents").where("doc_id % 5 = 0 or text is null").select("doc_id", "text", "lang").limit(120)
    docs = docs.union(spark.createDataFrame([(-1, None, "en"), (-2, "12 !", None), (-3, "É la", None)], docs.schema))
    mask = (1 << 64) - 1

    def bucket(gram):
        h = len(gram)
        for c, m in zip(gram, (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F), strict=False):
            h = (h * 0x100000001B3 + (32 if c in "\t\n\v\f\r" else ord(c)) * m) & mask
        for shift, mult in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            h = ((h ^ (h >> shift)) * mult) & mask
        return (h ^ (h >> 31)) % language.BUCKETS

    def grams(text):
        t = text.lower()
        return [bucket(t[i : i + n]) for n in (1, 2, 3, 4) for i in range(len(t) - n + 1)]

    told = lambda t: bool(t) and any(c.isalpha() for c in t)
    all_rows = [tuple(r) for r in docs.collect()]
    learned = [(t, x) for _, t, x in all_rows if t is not None and x is not None]
    langs = sorted({x for _, x in learned})
    counts = {x: Counter(b for t, y in learned if y == x and told(t) for b in grams(t)) for x in langs}
    total = {x: sum(c.values()) + 0.5 * language.BUCKETS for x, c in counts.items()}
    want = {}
    for d, t, _ in all_rows:
        if not told(t):
            want[d] = ("und", 0.0)
            continue
        some = Counter(grams(t))
        margin = {x: sum(n * math.log((counts[x][b] + 0.5) / total[x]) for b, n in some.items()) / 4 + math.log(sum(y == x for _, y in learned) / len(learned)) for x in langs}
        best = max(langs, key=margin.get)
        want[d] = (best, 1 / sum(math.exp(m - margin[best]) for m in margin.values()))
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.predict(docs, language.fit(docs)).collect()}
    assert {d: x[0] for d, x in found.items()} == {d: x[0] for d, x in want.items()}
    assert all(found[d][1] == pytest.approx(want[d][1], abs=1e-6) for d in want)


def test_language_without_id(spark, tmp_path):
    frame(spark, [(None, "some text"), (6, "mehr Text")]).write.parquet(f"{tmp_path}/documents.parquet")
    assert {r["doc_id"]: r["held_out"] for r in ALL["op1_language_id"](spark, str(tmp_path)).collect()}[None] is False


def test_sharding(spark, odd, sf_dir, whole):
    for df, docs in ((ALL["op8_sharding"](spark, sf_dir), whole), (sharding.shard(odd), odd_rows()), (sharding.shard(frame(spark, hot_rows())), hot_rows())):
        found = df.collect()
        assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in found), key=repr) == sorted(((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in docs), key=repr)
        slots = defaultdict(list)
        for r in found:
            slots[r["shard"]].append(r["slot"])
        assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) == set(range(8))
        assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_hot_slots_are_split(spark, monkeypatch):
    monkeypatch.setattr(sharding, "PART", 50)
    rows = hot_rows()
    found = sharding.shard(frame(spark, rows)).collect()
    slots = defaultdict(list)
    for r in found:
        slots[r["shard"]].append(r["slot"])
    assert len(found) == len(rows) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_bounded_shards(spark, sf_dir, whole):
    """No shard above its bound; a key is away from its own shard only where that one is full; a ninth shard moves few
    keys between the old ones."""
    docs = queries.table(spark, sf_dir, "documents")
    plain = {r["doc_id"]: r["shard"] for r in sharding.shard(docs, 8, slack=50.0).collect()}
    for slack in (0.1, 0.25):
        room = sharding.capacities(len(whole), 8, slack)[0]
        a = {r["doc_id"]: r["shard"] for r in sharding.shard(docs, 8, slack=slack).collect()}
        load = Counter(a.values())
        assert max(load.values()) <= room
        assert all(a[d] == plain[d] or load[plain[d]] == room for d in a)
        b = {r["doc_id"]: r["shard"] for r in sharding.shard(docs, 9, slack=slack).collect()}
        assert sum(a[d] != b[d] and b[d] != 8 for d in a) <= 0.03 * len(a)
    assert max(Counter(plain.values()).values()) > sharding.capacities(len(whole), 8, 0.1)[0]


def test_language_blocks(spark, sf_dir):
    """Every label is learned, whatever the number of languages held at once."""
    rows = [(i, chr(0x4E00 + 3 * i) * 40, f"l{i:03}") for i in range(203)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(2)
    assert got(language.predict(docs, language.fit(docs)), "doc_id", "lang_pred") == sorted(((i, x) for i, _, x in rows), key=repr)
    some = queries.table(spark, sf_dir, "documents").limit(150)
    one, split = (got(language.predict(some, language.fit(some, max_langs=n)), "doc_id", "lang_pred", "score") for n in (200, 3))
    assert [r[:2] for r in one] == [r[:2] for r in split] and len({r[1] for r in one}) > 3
    assert [r[2] for r in one] == pytest.approx([r[2] for r in split])


def test_fingerprints(spark, odd, sf_dir, whole):
    found = ALL["op9_fingerprints"](spark, sf_dir)
    assert got(found, "doc_id", "n_chars", "edited_sha256") == brute.edits(whole)
    prints = {r["doc_id"]: r for r in found.collect()}
    text = dict(whole)
    by_text = defaultdict(set)
    for d, t in whole:
        by_text[t or ""].add(prints[d]["fingerprint"])
    assert all(len(x) == 1 for x in by_text.values())
    order = sorted(text, reverse=True)
    off = []
    for i, d in enumerate(order):
        following = order[(i + 1) % len(order)]
        a, b = brute.shingles(text[d]), brute.shingles(text[following])
        if min(len(a), len(b)) > 100:
            off.append(abs(len(a & b) / len(a | b) - prints[d]["near_next"]))
    assert sum(off) / len(off) < 0.03
    assert fingerprint.sketches(odd).count() == len(odd_rows())
    # the edited text's likeness, against the sets themselves
    off = []
    for i, d in enumerate(order):
        t, following = text[d] or "", text[order[(i + 1) % len(order)]] or ""
        a, b = brute.shingles(t), brute.shingles(t[: len(t) - len(t) // 3] + following[: len(t) // 3])
        if len(a) > 100:
            off.append(abs(len(a & b) / len(a | b) - prints[d]["near_edited"]))
    assert sum(off) / len(off) < 0.03
    # of every document, short ones too: within five standard deviations of the sampling, and without bias
    signed = []
    for i, d in enumerate(order):
        t, following = text[d] or "", text[order[(i + 1) % len(order)]] or ""
        own, edit = brute.shingles(t), brute.shingles(t[: len(t) - len(t) // 3] + following[: len(t) // 3])
        for other, said in ((edit, prints[d]["near_edited"]), (brute.shingles(following), prints[d]["near_next"])):
            n = len(own | other)
            likeness = len(own & other) / n if n else 1.0
            kept = n / (fingerprint.FRACTION - 1)
            assert abs(said - likeness) <= 5 * math.sqrt(likeness * (1 - likeness) / max(kept, 1)) + 5 / max(kept, 1) * (0 < likeness < 1), (d, likeness, said)
            signed.append(said - likeness)
    assert abs(sum(signed) / len(signed)) < 0.005
    for d, x in prints.items():
        for printed in (x["fingerprint"], x["edited_fingerprint"]):
            assert str(fingerprint.Sketch.parse(printed)) == printed
    small, large = fingerprint.Sketch.of(" ".join(vocabulary()[:100])), fingerprint.Sketch.of(" ".join(vocabulary()))
    assert small.contained(large) == 1.0 and small.union(large).kept.tolist() == large.kept.tolist()
    few = [fingerprint.Sketch.of(f"{w} one two", fraction=1 << 40) for w in "abc"]
    assert all(not len(x.kept) for x in few)
    assert few[0].union(few[0]).likeness(few[0]) == 1.0 and few[0].union(few[1]).likeness(few[1].union(few[2])) == 0.0
    assert few[0].union(few[1]).union(few[2]).likeness(few[2].union(few[1]).union(few[0])) == 1.0
    coarse, fine = (fingerprint.Sketch.of(" ".join(vocabulary()), fraction=n) for n in (8, 2))
    assert coarse.likeness(fine) == 1.0 and 0.1 < small.likeness(fine) < 0.4 and fingerprint.Sketch.parse(str(fine)).likeness(coarse) == 1.0


def test_fingerprints_without_ids(spark):
    """Rows without an id go by their text's hash over many ranges; each is followed by the next one."""
    rows = [(None, f"text {i} " + "x" * (i % 7)) for i in range(300)] + [(i, f"t{i} one two") for i in range(50)]
    docs = frame(spark, rows)
    placed = fingerprint._with_neighbours(docs, 20).collect()
    assert max(Counter(r["place"] for r in placed).values()) < 100
    order = [r["text"] for r in docs.orderBy(F.desc_nulls_last("doc_id"), F.desc(F.xxhash64("text"))).collect()]
    want = sorted(brute.sha(t[: len(t) - len(t) // 3] + order[(i + 1) % len(order)][: len(t) // 3]) for i, t in enumerate(order))
    assert sorted(r["edited_sha256"] for r in fingerprint.edited_likeness(docs).collect()) == want


def test_chat(spark):
    rows = [(1, 2, "assistant", "b<|im_end|>\n\\"), (1, 1, "user", "a"), (1, 3, "user", None), (None, 1, "assistant", "x"), (2, 1, "system\n%", "<\\|im_start|>[INST]"), (2, 1, "system\n%", "<\\|im_start|>[INST]"), (3, 1, None, "")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1))
    made = chat.format_conversations(turns)
    read = sorted(chat.read_back(made).collect(), key=lambda r: r["nth"])
    losses, back = ({c: [] for c in (1, 2, 3, None)} for _ in range(2))
    for r in read:
        if not r["example"]:
            back[r["conv_id"]].append((r["role"], r["text"]))
        elif r["target"] is not None:
            losses[r["conv_id"]].append(r["target"])
    assert losses == {1: ["b<|im_end|>\n\\"], None: ["x"], 2: [], 3: []}
    assert back == {1: [("user", "a"), ("assistant", "b<|im_end|>\n\\"), ("user", "")], None: [("assistant", "x")], 2: [("system\n%", "<\\|im_start|>[INST]")] * 2, 3: [("", "")]}
    # spans that are off by one give other targets
    moved = made.withColumn("examples", F.transform("examples", lambda e: e.withField("loss_start", e["loss_start"] + 1).withField("loss_stop", e["loss_stop"] + 1)))
    assert {r["target"] for r in chat.read_back(moved).where("target is not null").collect()} == {"<|im_end|>\n\\", ""}
    examples = {(r["conv_id"], r["turn"]): r for r in chat.expand(made).collect()}
    assert examples[(1, 2)]["target"] == "b<\\|im_end|>\n\\" and examples[(1, 3)]["target"] is None
    assert chat.digests(chat.format_conversations(turns.limit(0))).count() == 0


def test_licences(spark):
    full = "You may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
    rows = [(1, f'Hello. Licensed under the Apache License, Version 2.0 (the "License"); {full}'), (2, None), (3, ""), (4, "Released under the\nMIT License.\n\nx. Released under the MIT license."), (5, full)]
    found = {r["doc_id"]: (r["licences"], r["n_matches"], r["unmatched"]) for r in licences.scan(frame(spark, rows)).collect()}
    assert found == {1: ("Apache-2.0", 1, ""), 2: ("", 0, ""), 3: ("", 0, ""), 4: ("MIT", 2, ""), 5: ("", 0, "apache-may,apache-copy")}


def test_licence_lines(spark):
    """Licence lines below lines that end no sentence, and a sentence over several lines among such lines."""
    line = "Licensed under the Apache License, Version 2.0."
    rows = [(1, f"Licence\n{line}"), (2, f"a | b |\n{line}"), (3, f"bota.***\n{line}\nmore"), (4, f"x $$$\r\n{line[:-1]}\r\ny"), (5, "About\n\tReleased under\n***\nthe MIT License\nNext"), (6, f"{line} {line}\n{line}")]
    rows += [(7, f"not {line}"), (8, f"Foo\n{line[:-1]} (the \"License\")\nBar"), (9, "Licensed. Under the Apache License, Version 2.0"), (10, "Licensed" + "\n*" * 20_000 + "\nunder CC BY 4.0")]
    found = {r["doc_id"]: (r["licences"], r["n_matches"], r["sentence_ids"]) for r in licences.scan(frame(spark, rows)).collect()}
    once = ("Apache-2.0", 1, "apache-ref")
    assert found == {1: once, 2: once, 3: once, 4: once, 5: ("MIT", 1, "mit-ref"), 6: ("Apache-2.0", 3, ",".join(["apache-ref"] * 3)), 7: ("", 0, ""), 8: ("Apache-2.0", 1, "apache-the"), 9: ("", 0, ""), 10: ("CC-BY-4.0", 1, "ccby4-ref")}


#: The notices as their licences print them.
NOTICES = {
    "GPL-3.0-or-later": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License
along with this program.  If not, see <https://www.gnu.org/licenses/>.
""",
    "Apache-2.0": """Copyright 2020 A. Body

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice,
   this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
""",
    "MIT": """The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
""",
}
THIRD = """
3. Neither the name of %s nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""


NOTICES |= {
    "LGPL-2.1-or-later": """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.

This library is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.

You should have received a copy of the GNU Lesser General Public
License along with this library; if not, see elsewhere.
""",
    "AGPL-3.0-or-later": NOTICES["GPL-3.0-or-later"].replace("GNU General", "GNU Affero General"),
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES
WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE
""",
    "Unlicense": "This is free and unencumbered software released into the public domain.\n",
    "CC0-1.0": "This work is released under CC0 1.0.\n",
    "GPL-2.0-only": "SPDX-License-Identifier: GPL-2.0-only\n",
}


def test_licence_names(spark):
    """Sentences that name a licence, identifier lines, and identifiers that are part of others."""
    rows = [(1, "This file is licensed under the MIT License."), (2, "// SPDX-License-Identifier: MPL-2.0\nint x;"), (3, "Distributed under the terms of the GNU Affero General Public License version 3."), (4, "SPDX-License-Identifier: GPL-3.0-or-later"), (5, "You should have received a copy of the GNU Lesser General Public License along with this program."), (6, "Permitted under the sun. We released it.")]
    found = {r["doc_id"]: (r["licences"], r["unmatched"]) for r in licences.scan(frame(spark, rows)).collect()}
    assert found == {1: ("MIT", ""), 2: ("MPL-2.0", ""), 3: ("AGPL-3.0-only", ""), 4: ("GPL-3.0-or-later", ""), 5: ("", "lgpl3-received"), 6: ("", "")}


#: Lines and notices, and the licences they name.
TOLD = {
    "SPDX-License-Identifier: MIT OR Apache-2.0": "Apache-2.0,MIT",
    "// SPDX-License-Identifier: GPL-2.0+\n": "GPL-2.0-or-later",
    "SPDX-License-Identifier: GPL-2.0": "GPL-2.0-only",
    "/* SPDX-License-Identifier: (GPL-2.0-only WITH Linux-syscall-note) AND BSD-3-Clause */": "BSD-3-Clause,GPL-2.0-only",
    "SPDX-License-Identifier: LGPL-2.1+ OR MPL-1.1": "LGPL-2.1-or-later,MPL-1.1",
    "SPDX-License-Identifier: Unknown-1.0": "",
    "This project is licensed under the MIT license - see the LICENSE file for details": "MIT",
    "# The MIT License\n\nCopyright me": "MIT",
    "Apache License, Version 2.0": "Apache-2.0",
    "Apache License\nVersion 2.0, January 2004": "",
    "Released under the GPLv3.": "GPL-3.0-only",
    "Boost Software License - Version 1.0 - August 17th, 2003": "BSL-1.0",
    "Distributed under the Boost Software License, Version 1.0.\n(See accompanying file)": "BSL-1.0",
    "This program and the accompanying materials are made available under the\nterms of the Eclipse Public License 2.0 which is available at\nhttps://www.eclipse.org/legal/epl-2.0": "EPL-2.0",
    "Licensed under the EUPL, Version 1.2 or – as soon they will be approved by\nthe European Commission - subsequent versions of the EUPL (the \"Licence\");\nYou may not use this work except in compliance with the Licence.": "EUPL-1.2",
    "This software is provided 'as-is', without any express or implied\nwarranty. In no event will the authors be held liable for any damages\narising from the use of this software.": "Zlib",
    "To the extent possible under law, Alice Person of Some Place has waived all copyright and related or neighboring rights to this work.": "CC0-1.0",
    "we like the mit license a lot": "",
}


def test_licence_lines_and_expressions(spark):
    found = {r["doc_id"]: r["licences"] for r in licences.scan(frame(spark, list(enumerate(TOLD)))).collect()}
    assert {t: found[i] for i, t in enumerate(TOLD)} == TOLD
    assert len(licences.SENTENCES) + len(licences.LINE) + len(licences._named()) > 200


def test_licence_notices(spark):
    """Every rule of several sentences from its notice, plain and as a comment."""
    wanted = [(name, text) for name, text in NOTICES.items()]
    wanted += [("BSD-3-Clause", NOTICES["BSD-2-Clause"] + THIRD % x) for x in ("the copyright holder", "the University of\nA, B and C")]
    wanted += [(name, "Some head\n" + "\n".join(" * " + x for x in text.split("\n"))) for name, text in wanted]
    found = {r["doc_id"]: (r["licences"], r["n_matches"], r["unmatched"]) for r in licences.scan(frame(spark, [(i, t) for i, (_, t) in enumerate(wanted)])).collect()}
    assert found == {i: (name, 1, "") for i, (name, _) in enumerate(wanted)}


def test_licence_sql_on_notices(spark, tmp_path):
    """The SQL on notices, lines and names that the fixtures do not hold."""
    import duckdb

    rows = list(enumerate([*TOLD, *NOTICES.values(), *["# " + x.replace("\n", "\n# ") for x in NOTICES.values()], NOTICES["BSD-2-Clause"] + THIRD % "the University of\nA, B and C", "Foo\nLicensed under the Apache License, Version 2.0 (the \"License\")\nBar", "a | b |\nReleased under\n***\nthe MIT License", None, "", "MIT License. released under the MIT License. Released under the MIT License"]))
    docs = frame(spark, rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    df = licences.scan(docs)
    assert got(df, *df.columns) == sorted(con.sql(f"SELECT {', '.join(df.columns)} FROM ({licences.ORACLE})").fetchall(), key=repr)


@pytest.mark.parametrize("name", ["op2_chat_formatting", "op6_licence_scan"])
def test_sql(spark, sf_dir, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    df = ALL[name](spark, sf_dir)
    assert got(df, *df.columns) == sorted(con.sql(f"SELECT {', '.join(df.columns)} FROM ({queries.oracle_sql()[name]})").fetchall(), key=repr)


@pytest.mark.parametrize("name", list(ALL))
def test_empty_tables(spark, sf_dir, tmp_path, name):
    for t in ("documents", "labels", "conversations", "embeddings"):
        queries.table(spark, sf_dir, t).limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert ALL[name](spark, str(tmp_path)).count() == (1 if name == "op2_chat_formatting" else 0)
