"""The ten operators against plain Python versions, on a small fixture that holds the awkward cases."""

from __future__ import annotations

import hashlib
import random
import zlib

import brute
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tidemark.llm import byte_bpe, chat, exact_dedup, flac, media, packing, pii, quality, sharding, simhash, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, lost_id long, fp string, key string, shard int, held string, score double"


def _texts() -> list[str | None]:
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(60)]
    prose = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 400))) for _ in range(25)]
    near = [prose[3] + " tail", prose[3].upper(), prose[5] + ".", prose[5] + "!"]
    personal = [
        "mail a.b@c-d.example.org and x@y or z@q.de@w.com now",
        "ips 10.0.0.1 256.1.1.1 1.2.3.4.5.6.7.8 999.1.1.1.1 00010.02.3.4",
        "cards 4111 1111 1111 1111 4111-1111-1111-1111 4111111111111112 1234 5678 and 4111 1111  1111 1111",
        "phones +49 (0)30-123456 +1 +12345678 +1 234 567 890 123 456 7 +4 9.",
        "\U0001f600 mixed éè a@b.cd \U0001f600 +49 30 123456",
    ]
    odd = [None, "", " ", "\t\n", "one", "one two", "ÉCOLE İ", " ", "a" * 70_000, " ".join(["word"] * 30_000), "<|endoftext|> x", "\x00\x01\x1f", "\\u0041 ### </turn>\n"]
    return prose + near + personal + odd + prose[:6] + prose[:2]


ROWS = [(i * 3 + 1, t) for i, t in enumerate(_texts())]
TEXT = {d: t or "" for d, t in ROWS}


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(d, t, None if d % 5 == 0 else "xx", None if d % 7 == 0 else "web", 1, "clash", d, "clash", "clash", 3, "clash", 0.5) for d, t in ROWS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def _by_id(df, *columns):
    rows = df.select("doc_id", *columns).collect()
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: tuple(r[1:]) for r in rows}


HOSTILE = ["", None, "### ", "</turn>", "</turn>\n### user:0\nx</turn>\n", "\\### x", "##\\# y", "<\\/turn>", "\\s ### \\", "a\\\\s</turn", "#### ", "plain\ntext", "### ### </turn></turn>\n"]


def test_chat_round_trip(spark):
    rng = random.Random(1)
    rows = [(c, t, rng.choice(["user", "assistant", "system", None, "odd:0\n\\role"]), "".join(rng.choice([h or "" for h in HOSTILE]) for _ in range(rng.randint(0, 4)))) for c in range(40) for t in range(rng.randint(1, 5))]
    rows += [(99, 0, "assistant", h) for h in HOSTILE] + [(None, None, None, None), (98, None, "user", "x"), (98, 1, "user", "x"), (98, 1, "user", "x")]
    made = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit("clash")))
    out = {r[0]: tuple(r[1:5]) for r in chat.digests(made).collect()}
    assert out == brute.turns(rows)
    for r in made.collect():  # the mask covers the bodies of assistant turns and nothing else
        at = 0
        for turn, place in zip(r["turns"], r["layout"]):
            assert place["loss"] == (turn["role"] == "assistant")
            body = r["formatted"][at + place["body_start"] : at + place["body_start"] + place["body_chars"]]
            assert r["formatted"][at : at + 4] == "### " and (place["level"] > 0 or body == turn["text"])
            at += place["chars"]
        assert at == len(r["formatted"])
    assert all(r["verified"] for r in made.collect())
    for r in made.collect():
        assert r["formatted"].count("</turn>\n") == len(r["turns"])


def test_chat_empty(spark):
    assert chat.digests(chat.format_conversations(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))).count() == 0


@pytest.mark.parametrize("tree", [2_000, 3])
def test_simhash(docs, tree):
    assert _by_id(simhash.components(docs, tree=tree), "fingerprint", "component_id") == brute.components(ROWS)


def test_simhash_links_of_dense_fingerprints(spark):
    rng = random.Random(5)
    centres = [rng.getrandbits(64) for _ in range(30)]
    values = sorted({c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for c in centres for _ in range(40)})
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    links = simhash.links(spark.createDataFrame(signed, "fp long"), tree=7)
    roots = {r["node"]: r["root"] for r in simhash.connected(links).collect()}
    up = {v: v for v in values}

    def top(v):
        while up[v] != v:
            v = up[v]
        return v

    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= 2:
                up[top(a)] = top(b)
    mine = {v: roots.get(s[0], s[0]) for v, s in zip(values, signed)}
    for i, a in enumerate(values):
        for b in values[:i]:
            assert (top(a) == top(b)) == (mine[a] == mine[b])


def test_tree_follows_only_useful_edges():
    rng = random.Random(2)
    values = [rng.getrandbits(12) for _ in range(300)]
    tree = simhash.Tree()
    for v in dict.fromkeys(values):
        tree.add(v)
    for q in range(0, 4096, 37):
        assert sorted(tree.near(q, 2)) == sorted(v for v in set(values) if (v ^ q).bit_count() <= 2)


def test_near_duplicates_dropped(docs):
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    expected = brute.components(ROWS)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, c in expected.values()})
    assert sorted(r["doc_id"] for r in simhash.drop_near_duplicates(docs, broadcast_rows=0).collect()) == sorted({c for _, c in expected.values()})


def test_packing(docs):
    path = public_tokenizers.path("byte_bpe_50k.json")
    placed = packing.pack(docs, path).collect()
    assert sorted(tuple(r)[:5] for r in placed) == sorted(brute.pieces(ROWS, path))
    sequences: dict[int, list] = {}
    for r in placed:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    total = sum(r["length"] for r in placed)
    assert len(sequences) <= -(-total // packing.CAPACITY) + 1


def test_packing_keeps_the_type_of_ids(spark):
    docs = spark.createDataFrame([("a-1", "one two"), ("b", None), (None, "x"), ("b", None)], "doc_id string, text string")
    placed = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json")).collect()
    assert sorted((r["doc_id"] or "" for r in placed)) == ["", "a-1", "b", "b"] and len({r["sequence_id"] for r in placed}) == 1


def test_packing_plan_is_tight():
    rng = np.random.default_rng(4)
    lengths = np.minimum(2048, rng.lognormal(5.5, 1.2, 50_000).astype(int) + 1)
    values, counts = np.unique(lengths, return_counts=True)
    runs, sequences = packing.plan(dict(zip(values.tolist(), counts.tolist())))
    assert runs[:, 2].sum() == len(lengths)
    assert sequences <= 1.003 * lengths.sum() / 2048 + 1


def test_media(docs):
    stored = media.store(docs)
    assert _by_id(media.load(stored), "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32") == {d: brute.media(t) for d, t in ROWS}
    streams = {r["doc_id"]: bytes(r["media"]) for r in stored.collect()}
    blocks = media.pcm_blocks(stored).collect()
    for d in list(TEXT)[:30]:
        own = b"".join(bytes(r["pcm"]) for r in sorted((b for b in blocks if b["doc_id"] == d), key=lambda b: b["sample_offset"]))
        assert own == media.payload(TEXT[d]) and flac.read_block(streams[d], 0) == own[:576]
    by_text: dict[str, set] = {}
    for d, s in streams.items():
        by_text.setdefault(TEXT[d], set()).add(s)
    assert all(len(s) == 1 for s in by_text.values())


def _bits(value: int, n: int) -> str:
    return format(value & ((1 << n) - 1), f"0{n}b")


def _plain_flac(payload: bytes) -> bytes:
    """A stream written bit by bit after the format's description, sharing no code with the operator: second differences, one partition."""

    def crc(data: bytes, polynomial: int, width: int) -> int:
        value, top = 0, 1 << (width - 1)
        for byte in data:
            value ^= byte << (width - 8)
            for _ in range(8):
                value = ((value << 1) ^ polynomial if value & top else value << 1) & ((1 << width) - 1)
        return value

    frames = []
    samples = [b - 128 for b in payload]
    for n in range(0, len(samples), 576):
        x = samples[n : n + 576]
        head = bytes([0xFF, 0xF8, 0x20, 0x02, n // 576])
        head += bytes([crc(head, 0x07, 8)])
        rest = [x[i] - 2 * x[i - 1] + x[i - 2] for i in range(2, 576)]
        folded = [2 * r if r >= 0 else -2 * r - 1 for r in rest]
        k = min(range(15), key=lambda k: sum((f >> k) + 1 + k for f in folded))
        body = _bits((8 + 2) << 1, 8) + _bits(x[0], 8) + _bits(x[1], 8) + "00" + "0000" + _bits(k, 4)
        body += "".join("0" * (f >> k) + "1" + (_bits(f, k) if k else "") for f in folded)
        body += "0" * (-len(body) % 8)
        frame = head + bytes(int(body[i : i + 8], 2) for i in range(0, len(body), 8))
        frames.append(frame + crc(frame, 0x8005, 16).to_bytes(2, "big"))
    sizes = [len(f) for f in frames]
    pcm = bytes(s & 255 for s in samples)
    info = (576).to_bytes(2, "big") * 2 + min(sizes).to_bytes(3, "big") + max(sizes).to_bytes(3, "big")
    info += ((8_000 << 44) | (0 << 41) | (7 << 36) | len(samples)).to_bytes(8, "big") + hashlib.md5(pcm).digest()
    seek = b"".join((i * 576).to_bytes(8, "big") + sum(sizes[:i]).to_bytes(8, "big") + (576).to_bytes(2, "big") for i in range(len(frames)))
    return b"fLaC" + bytes([0]) + len(info).to_bytes(3, "big") + info + bytes([0x83]) + len(seek).to_bytes(3, "big") + seek + b"".join(frames)


def test_flac_forms_and_damage():
    rng = np.random.default_rng(0)
    wave = (127 + 90 * np.sin(np.arange(576 * 3) / 9)).astype(np.uint8).tobytes()
    ramp = (np.arange(576) % 256).astype(np.uint8).tobytes()
    noise = rng.integers(0, 256, 576 * 2).astype(np.uint8).tobytes()
    payloads = [wave, ramp, noise, b"\xff" * 576, bytes(575) + b"\xff"]
    for order in (0, 4):
        streams = flac.write_streams(payloads, order)
        assert flac.read_streams(streams) == payloads
        assert flac.read_block(streams[0], 2) == wave[1152:]
    assert flac.read_streams([_plain_flac(p) for p in payloads]) == payloads
    broken = bytearray(flac.write_streams([wave])[0])
    broken[-40] ^= 1
    with pytest.raises(ValueError):
        flac.read_streams([bytes(broken)])


def test_personal_data(docs):
    assert _by_id(pii.report(docs), "n_email", "n_ip", "n_card", "n_phone", "base_sha256") == {d: brute.personal(t) for d, t in ROWS}


def test_terms_and_classes_against_plain_counts(spark):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefg") for _ in range(rng.randint(2, 7))) for _ in range(150)] + ["zone", "quiet", "quilt"]
    rows = []
    for i in range(260):
        own = [rng.choice(words) for _ in range(rng.randint(5, 30))]
        if i % 9 == 0:
            own[rng.randrange(len(own))] = f"u{i}@mail.example.org"
            own.append(rng.choice(["Zorblax", "zorbs", "quillon", "abcdefgh"]))
        if i % 31 == 0:
            own += ["+49 30 1234567", "Vennig"]
        if i == 7:
            own.append("zorblax")
        rows.append((i, " ".join(own)))
    rows += [(1000, None), (1001, ""), (1002, rows[9][1]), (1003, rows[9][1])]
    clean, spans = brute.sanitised([t for _, t in rows])
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    report = {r["doc_id"]: r["spans"] for r in pii.report(docs).collect()}
    base = [brute.base_spans(t or "") for _, t in rows]
    assert report == {d: ",".join(f"{k}:{a}:{b}" for k, a, b in [*own, *terms]) for (d, _), own, terms in zip(rows, base, spans)}
    assert {r["doc_id"]: r["text"] for r in pii.sanitise(docs).collect()} == {d: c for (d, _), c in zip(rows, clean)}
    assert sum(map(len, spans)) > 20
    general, _ = brute.sanitised([t for _, t in rows], remove=2.0)
    assert {r["doc_id"]: r["text"] for r in pii.sanitise(docs, remove=2.0).collect()} == {d: c for (d, _), c in zip(rows, general)}
    assert any("*" in (c or "") for c in general)


def test_terms_that_disclose(spark):
    rows = [(i, f"the file says patient {'zorblax' if i % 2 else 'quiet'} is at user{i}@mail.example.com for the doctor") for i in range(0, 40)]
    rows += [(100 + i, "the file says the doctor is quiet and the mail is late for all") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spans = {r["doc_id"]: r["spans"] for r in pii.report(docs).collect()}
    assert "term:" in spans[1] and "term:" not in spans[101]
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(docs).collect()}
    assert "zorblax" not in clean[1] and "@" not in clean[1] and "quiet" in clean[2] and "[EMAIL]" in clean[2]
    assert clean[101] == rows[41][1]


def test_sanitise_keeps_rows_and_columns(docs):
    clean = pii.sanitise(docs)
    assert clean.columns == docs.columns and clean.count() == docs.count()
    for r in clean.collect():
        found = brute.base_spans(TEXT[r["doc_id"]])
        if not found:
            assert r["text"] == dict(ROWS)[r["doc_id"]]


def test_shards(docs):
    rows = sharding.shards(docs, count=7).collect()
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in rows} == {d: (len(t.encode()) + 16, zlib.crc32(t.encode())) for d, t in TEXT.items()}
    slots: dict[int, list] = {s: [] for s in range(7)}
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    by_cell = sorted((r["cell"], r["shard"]) for r in rows)
    assert [s for _, s in by_cell] == sorted(s for _, s in by_cell)


def test_hilbert_steps_are_single():
    for dims, bits in ((2, 4), (3, 3)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        index = sharding.hilbert_index(grid, bits)
        assert sorted(index) == list(range(len(grid)))
        assert (np.abs(np.diff(grid[np.argsort(index)], axis=0)).sum(1) == 1).all()


def test_shards_written_and_pruned(spark, docs, tmp_path):
    sharding.write(docs, sharding.shards(docs, count=5), f"file://{tmp_path}/out", rows_per_task=3)
    assert spark.read.parquet(f"file://{tmp_path}/out").count() == docs.count()


def test_shards_keep_metadata_together(spark):
    rows = [(i, "x" * (1 << (i // 40 % 6) + 4), f"l{i % 4}", f"s{i // 4 % 10}") for i in range(4_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    placed = sharding.shards(docs, count=20).join(docs, "doc_id").groupBy("shard").agg(F.countDistinct("lang").alias("langs"), F.countDistinct("source").alias("sources"), F.countDistinct("size").alias("sizes")).collect()
    # a reader that wants one language, source or size skips most shards
    assert sum(r["langs"] for r in placed) <= 0.5 * 4 * 20
    assert sum(r["sources"] for r in placed) <= 0.6 * 10 * 20
    assert sum(r["sizes"] for r in placed) <= 0.8 * 6 * 20
    assert sharding.shards(docs.drop("lang", "source"), count=20).count() == len(rows)


def test_shards_against_a_plain_order(docs):
    """Positions by sorting all rows at once."""
    made = sharding.shards(docs, count=7)
    rows = made.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(sharding.BUCKETS))).collect()
    order = sorted(rows, key=lambda r: (r["cell"], r["bucket"], r["doc_id"], r["text_crc32"]))
    first: dict[int, int] = {}
    for position, r in enumerate(order):
        shard = position * 7 // len(order)
        first.setdefault(shard, position)
        assert (r["shard"], r["slot"]) == (shard, position - first[shard])


@pytest.mark.parametrize(("chunk", "overlap"), [(32_768, 512), (64, 16), (200, 40)])
def test_byte_bpe(docs, chunk, overlap):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoder = brute.rank_encoder(path, public_tokenizers.PATTERN)
    made = byte_bpe.digests(docs, path, public_tokenizers.PATTERN, chunk=chunk, overlap=overlap)
    assert _by_id(made, "n_tokens", "ids_sha256", "decoded_sha256") == {d: brute.encoded(t, encoder) for d, t in ROWS}


def test_exact_dedup(spark, docs):
    assert _by_id(exact_dedup.decisions(docs), "keep_id", "group_size", "kept", "text_sha256") == brute.kept(ROWS)
    for limit in (0, 1_000):
        left = exact_dedup.drop_duplicates(docs, broadcast_rows=limit)
        assert left.columns == docs.columns
        assert sorted(r["doc_id"] for r in left.collect()) == sorted(d for d, (_, _, k, _) in brute.kept(ROWS).items() if k)
    repeated = spark.createDataFrame([(1, "a"), (1, "a"), (None, "A"), (None, None), (2, "")], "doc_id long, text string")
    rows = sorted((tuple(r)[:4] for r in exact_dedup.decisions(repeated).collect()), key=str)
    assert rows == sorted([(1, 1, 3, True), (1, 1, 3, True), (None, 1, 3, False), (None, 2, 2, False), (2, 2, 2, True)], key=str)


@pytest.mark.parametrize("limit", [0, 1_000])
@pytest.mark.parametrize("drop", [exact_dedup.drop_duplicates, simhash.drop_near_duplicates])
def test_repeated_rows_leave_one(spark, drop, limit):
    rows = [(1, "a", "x"), (1, "a", "y"), (1, "b", "z"), (None, "c", "x"), (None, "c", None), (None, "C", "x"), (7, "d", "x"), (8, "D", "x"), (8, "D", "x")]
    kept = drop(spark.createDataFrame(rows, "doc_id long, text string, lost_id string"), broadcast_rows=limit)
    assert kept.columns == ["doc_id", "text", "lost_id"]
    last = 8 if drop is exact_dedup.drop_duplicates else 7
    assert sorted(((r["doc_id"], r["text"].lower()) for r in kept.collect()), key=str) == sorted([(1, "a"), (1, "b"), (None, "c"), (last, "d")], key=str)


def _labelled(spark, column):
    rng = random.Random(9)
    good = ["the", "river", "and", "Stone", "bridge", "holds", "water", "early", "morning", "light"]
    rows, labels = [], []
    for i in range(240):
        y = i % 2
        own = [rng.choice(good) for _ in range(rng.randint(40, 90))]
        if column == "toxic" and y:
            own[rng.randrange(len(own))] = rng.choice(["vilegit", "vilegut"])
        if column == "quality" and not y:
            own = [rng.choice(["$$", "##1", "x9", "BUY", "!!"]) for _ in own]
        rows.append((i, " ".join(own)))
        labels.append((i, y))
    rows += [(1000, None), (1001, ""), (1002, "word " * 20_000)]
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([*labels, (5000, None), (5001, 7)], f"doc_id long, {column} int")


def test_toxicity_held_out(spark):
    docs, labels = _labelled(spark, "toxic")
    model = toxicity.fit(docs, labels.filter("doc_id % 5 <> 0"))
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    held = [d for d in range(0, 240, 5)]
    assert sum((scores[d] >= 0.5) == (d % 2 == 1) for d in held) >= 0.9 * len(held)
    assert all(0 <= s <= 1 for s in scores.values()) and scores[1000] == scores[1001]


def test_toxicity_against_a_plain_forward_pass(spark):
    docs, labels = _labelled(spark, "toxic")
    net = toxicity.fit(docs, labels.filter("doc_id % 5 <> 0"))
    texts = [t or "" for _, t in ROWS if len(t or "") < 4_000] + ["vilegit", "the vilegut river " * 40]
    made = toxicity.Scorer(net).scores(texts)
    assert np.allclose(made, [brute.toxicity_score(net, t) for t in texts], atol=2e-4)
    assert toxicity.Scorer(net).scores(["the vilegit " + "river " * 500])[0] > toxicity.Scorer(net).scores(["river " * 500])[0]


def test_toxicity_learns_from_long_texts_within_a_bound(spark, monkeypatch):
    docs, labels = _labelled(spark, "toxic")
    longer = docs.filter("doc_id < 40").withColumn("text", F.array_join(F.array_repeat("text", 40), " "))
    seen = []
    train = toxicity.train
    monkeypatch.setattr(toxicity, "train", lambda texts, y, *a: (seen.extend(texts), train(texts, y, *a))[1])
    model = toxicity.fit(longer, labels, longest=1_600)
    assert len(seen) == 40 and all(1_500 < len(t) <= 1_600 + toxicity.PARTS for t in seen)
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(longer, model).collect()}
    assert sum((s >= 0.5) == (d % 2 == 1) for d, s in scores.items()) >= 28


def test_toxicity_gradients():
    rng = np.random.default_rng(0)
    net = toxicity.Network({"a": 1, "b": 2}, {"<a>": 1, "<b>": 2}, np.zeros(3, np.float32), np.zeros(3, np.float32))
    net.p = {k: rng.standard_normal(v.shape) * 0.5 for k, v in net.p.items()}
    net.p["word"][0] = net.p["gram"][0] = 0
    described = net.describe(["a", "b", "c"])
    ids = np.array([[0, 1, 2, 0], [1, 1, -1, -1]])
    mask, target, weight = (ids >= 0).astype(float), np.array([1.0, 0.0]), np.array([1.0, 2.0])

    def loss():
        table = np.concatenate([net.projected(net.inputs(described)), np.zeros((1, 6 * toxicity.UNITS))])
        z = net.forward(table, ids, mask)
        p = 1 / (1 + np.exp(-z))
        return -(weight * (target * np.log(p) + (1 - target) * np.log(1 - p))).sum() / weight.sum()

    exact = net.gradients(described, ids, mask, target, weight)
    for name in ("in", "up_f", "up_b", "rec_f", "rec_b", "look", "out", "out_b", "word", "gram"):
        place = tuple(n - 1 for n in net.p[name].shape)
        before = net.p[name][place]
        net.p[name][place] = before + 1e-4
        more = loss()
        net.p[name][place] = before - 1e-4
        less = loss()
        net.p[name][place] = before
        assert abs((more - less) / 2e-4 - exact[name][place]) < 2e-3, name


def test_quality_held_out(spark):
    docs, labels = _labelled(spark, "quality")
    described = quality.features(docs)
    model = quality.fit(described, labels.filter("doc_id % 4 <> 2"))
    scores = {r["doc_id"]: r["score"] for r in quality.scores(described, model).collect()}
    held = [d for d in range(2, 240, 4)]
    assert all((scores[d] >= 0.7) == (d % 2 == 1) for d in held)
    kept = {r["doc_id"] for r in quality.keep(docs, labels).collect()}
    assert {d for d in range(1, 240, 2)} <= kept and not kept & {d for d in range(0, 240, 2)}
    assert all(0 <= s <= 1 for s in scores.values())


def test_quality_against_plain_densities(spark):
    docs, labels = _labelled(spark, "quality")
    extra = [(2000 + i, t) for i, t in enumerate(t for _, t in ROWS if len(t or "") < 4_000)]
    docs = docs.unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    rows = [(r["doc_id"], r["text"] or "") for r in docs.collect() if len(r["text"] or "") < 4_000]
    known = {r["doc_id"]: r["quality"] for r in labels.filter("doc_id % 4 <> 2").collect()}
    described = quality.features(docs)
    made = {r["doc_id"]: r["score"] for r in quality.scores(described, quality.fit(described, labels.filter("doc_id % 4 <> 2"))).collect()}
    expected = brute.quality_scores([(t, known[d]) for d, t in rows if known.get(d) in (0, 1)], [t for _, t in rows])
    assert np.allclose([made[d] for d, _ in rows], expected, atol=1e-6)


def test_one_kind_of_label_or_none(spark, docs):
    for rows, expected in (([(1, 1)], 1.0), ([], None)):
        labels = spark.createDataFrame(rows, "doc_id long, quality int").withColumn("toxic", F.col("quality"))
        described = quality.features(docs)
        assert {r["score"] for r in quality.scores(described, quality.fit(described, labels)).collect()} == {0.5 if expected is None else expected}
        assert {r["score"] for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()} == {0.0 if expected is None else expected}


def test_empty_tables(spark, none):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    path = public_tokenizers.path("byte_bpe_50k.json")
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    for made in (
        simhash.components(none),
        simhash.drop_near_duplicates(none),
        packing.pack(none, path),
        media.load(media.store(none)),
        toxicity.score(none, toxicity.fit(none, labels)),
        pii.report(none),
        pii.sanitise(none),
        quality.scores(quality.features(none), quality.fit(quality.features(none), labels)),
        quality.keep(none, labels),
        sharding.shards(none),
        byte_bpe.digests(none, ranks, public_tokenizers.PATTERN),
        exact_dedup.decisions(none),
        exact_dedup.drop_duplicates(none),
    ):
        assert made.count() == 0
