"""The operators against brute force, and their cases of nulls, empty texts, ties, repeated rows and empty tables."""

import collections
import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rankloom.llm import chat, graph, jaccard, language, licenses, mixing, neardup, pieces, quality, queries, shards, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [None, "", " \n\t ", "a", "a b", "A B c d e", "a b c d e", "é ñ 中文 ▁ x", "x " * 30_000, "line one here\n" * 40]


@pytest.fixture(scope="session")
def odd(spark):
    rows = [(i, t, "en" if i % 2 else None, None if i == 3 else "s", None) for i, t in enumerate(ODD)]
    rows += [(None, "a b c d e f", None, "s", 1), (5, "A B c d e", "en", "s", 1), (5, "A B c d e", "en", "s", 1)]
    return spark.createDataFrame(rows, DOCS).withColumns({c: F.lit(1) for c in ("score", "shard", "slot", "kept", "n", "component")})


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)


def test_chat_windows_read_back(spark):
    rng = random.Random(3)
    parts = ["<|im_end|>", "<|im_start|>", "[INST]", "</s>", "\\", "<", "[", "word", "é", "\n", "|im_sep|>", "<|im_sep|>"]
    rows = []
    for conv in range(40):
        for turn in range(rng.randrange(1, 12)):
            role = "system" if turn == 0 and conv % 2 else rng.choice(["user", "assistant", None, "a<|im_sep|>b"])
            text = None if rng.random() < 0.1 else "".join(rng.choice(parts) for _ in range(rng.randrange(0, 60)))
            rows.append((conv, turn, role, text))
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for budget, history in ((30, 10), (60, 0), (10_000, 100)):
        made = chat.windows(df, budget, history)
        back = {r["conv_id"]: r for r in chat.read_back(made).collect()}
        for conv in range(40):
            turns = [(r or "", t or "") for c, _, r, t in rows if c == conv]
            assert [(t["role"], t["text"]) for t in back[conv]["turns"]] == turns
            assert back[conv]["learned"] == "".join(t for r, t in turns if r == "assistant")
        for w in made.collect():
            shown = w["formatted"].count(chat.END)
            assert w["n_tokens"] <= budget or shown - w["n_repeated"] <= 1 + (w["window"] == 0)
    assert chat.read_back(chat.windows(df.limit(0))).count() == 0


def test_chat_query_digests(spark, sf_dir):
    got = {r["conv_id"]: r for r in queries.op1_chat_windows(spark, sf_dir).collect()}
    turns = collections.defaultdict(list)
    for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").orderBy("conv_id", "turn").collect():
        turns[r["conv_id"]].append((r["role"], r["text"] or ""))
    turns[-7] = [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]
    assert set(got) == set(turns)
    for conv, said in turns.items():
        learned = "".join(t for r, t in said if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for r, t in said)
        assert got[conv]["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
        assert got[conv]["loss_sha256"] == hashlib.sha256(learned.encode()).hexdigest()
        assert (got[conv]["loss_chars"], got[conv]["n_turns"]) == (len(learned), len(said))


def test_shards(spark, sf_dir, odd, none):
    rows = queries.op7_rendezvous_shards(spark, sf_dir).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        body = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(body) + 1, zlib.crc32(body))
        assert r["grown_shard"] in (r["shard"], 8)
    for shard in range(8):
        slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert slots == list(range(len(slots))) and len(slots) > 5
    out = shards.shard(odd, {0: 1.0, 1: 3.0}).collect()
    assert len(out) == len(ODD) + 3 and len({r["shard"] for r in out if r["doc_id"] == 5}) == 1
    assert shards.shard(none, {0: 1.0}).count() == 0


def test_shard_weights(spark):
    rows = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    counts = dict(shards.shard(rows, {0: 1.0, 1: 3.0}).groupBy("shard").count().collect())
    assert abs(counts[1] / 20_000 - 0.75) < 0.02


def test_language(spark, sf_dir, odd, none):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = queries.op6_language_id(spark, sf_dir).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    held = out[out["held_out"]]
    assert len(out) == docs.count() and (held["lang"] == held["lang_pred"]).mean() > 0.95
    model = language.fit(docs)
    rows = language.identify(odd, model).collect()
    assert [r["lang_pred"] for r in rows[:3]] == ["und"] * 3 and len(rows) == len(ODD) + 3
    assert language.fit(none).languages == ["und"] and language.identify(none, model).count() == 0


def test_follow_the_leader_is_sparse():
    rng = np.random.default_rng(0)
    examples = [(np.array([y, 2 + rng.integers(50)]), np.ones(2), y) for y in rng.integers(0, 2, 300)]
    weights, _ = language.follow_the_leader(examples, 2, 3, 0.5, 1.0, 2.0, 0.01)
    assert weights[0, 0] > 0 > weights[1, 0] and (weights[52:] == 0).all() and (weights[2:52] == 0).mean() > 0.3


def brute_segments(w):
    """All maximal segments: each is the best run of its surroundings, cut out again and again."""
    out = []

    def cut(lo, hi):
        best = max(((sum(w[i:j]), -(j - i), -i, i, j) for i in range(lo, hi) for j in range(i + 1, hi + 1)), default=None)
        if best and best[0] > 0:
            out.append((best[3], best[4], best[0]))
            cut(lo, best[3])
            cut(best[4], hi)

    cut(0, len(w))
    return sorted(out)


def test_segments_against_brute_force():
    rng = random.Random(5)
    for _ in range(300):
        w = [rng.choice([-7, -3, -1, 2, 5, 11]) + rng.random() / 1000 for _ in range(rng.randrange(0, 14))]
        got = [(s, e, round(x, 6)) for s, e, x in toxicity.segments(np.array(w))]
        assert got == [(s, e, round(x, 6)) for s, e, x in brute_segments(w)]


def test_toxicity(spark, odd, none):
    docs = [(i, " ".join(random.Random(i).choices("one two three four five six".split(), k=60))) for i in range(300)]
    docs = [(i, t.replace("six", "vile", 3) if i % 4 == 0 else t, None, None, None) for i, t in docs]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(300)], "doc_id long, toxic int")
    df = spark.createDataFrame(docs, DOCS)
    model = toxicity.fit(df, labels)
    out = toxicity.assess(df, model).collect()
    right = sum(r["predicted"] == int(r["doc_id"] % 4 == 0) for r in out if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
    assert right > 0.95 * sum(zlib.crc32(str(i).encode()) % 3 == 1 for i in range(300))
    rows = toxicity.assess(odd, model).collect()
    assert len(rows) == len(ODD) + 3 and all(0 <= r["score"] < 0.7 for r in rows)
    empty = toxicity.fit(none, labels)
    assert toxicity.assess(none, empty).count() == 0 and empty.score([]) < 0.5


def test_pieces_against_the_library():
    sentencepiece = pytest.importorskip("sentencepiece")
    model = sentencepiece.SentencePieceProcessor(model_file=queries.TOKENIZER)
    transducer = pieces.Transducer(pieces.Vocabulary.read(queries.TOKENIZER))
    rng = random.Random(1)
    for i in range(2000):
        text = "".join(rng.choice("abcdehilnoprstuABZ  \n\t.,;éñß中文ﬁ01\r😀") for _ in range(rng.randrange(0, 50)))
        ids = np.frombuffer(transducer.encode(text), np.int32).tolist()
        assert ids == model.encode(text) and transducer.decode(ids) == text
    for text in ("▁x ▁▁ y", "▁", "  ", "word " * 2000 + "y" * 500):
        assert transducer.decode(np.frombuffer(transducer.encode(text), np.int32).tolist()) == text


def test_pieces_query(spark, sf_dir, odd, none):
    assert queries.op3_sentence_pieces(spark, sf_dir).where("not restored").count() == 0
    coded = pieces.encode(odd, queries.TOKENIZER)
    back = pieces.decode(coded, queries.TOKENIZER, into="again")
    assert back.where("not (again <=> text)").count() == 0 and back.where("input_ids is null").count() == 1
    assert pieces.encode(none, queries.TOKENIZER).count() == 0


def test_mix(spark, odd, none):
    rows = [(i, "t", None, "a" if i < 600 else "b" if i < 900 else f"c{i % 3}", None) for i in range(1000)]
    df = spark.createDataFrame(rows, DOCS)
    weights = {"a": 0.5, "b": 0.3, "c0": 0.1, "c1": 0.05, "c2": 0.05}
    out = sorted(mixing.mix(df, weights, block_rows=8).collect(), key=lambda r: r["mix_position"])
    assert [r["mix_position"] for r in out] == list(range(1000)) and len({r["doc_id"] for r in out}) == 1000
    parts, placed = mixing.whole_weights(weights), collections.Counter()
    blocks = sorted({(r["mix_slot"], r["source"]) for r in out})
    first_end = mixing.phases(collections.Counter(r[3] for r in rows), weights, 8, 1000)[0].length
    for slot, source in blocks[:first_end]:
        placed[source] += 1
        assert all(abs(placed[s] - (slot + 1) * p / 1000) < 1 for s, p in parts.items())
    assert mixing.mix(odd).count() == len(ODD) + 3 and mixing.mix(none).count() == 0
    assert [r["doc_id"] for r in mixing.in_order(mixing.mix(df, weights, block_rows=8)).collect()] == [r["doc_id"] for r in out]


def test_quality_figures_and_lines(spark, odd, none):
    rng = random.Random(2)
    for _ in range(200):
        words = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randrange(0, 30))]
        seen, covered = collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4)), set()
        for i in range(len(words) - 4):
            if seen[tuple(words[i : i + 5])] > 1:
                covered |= set(range(i, i + 5))
        assert quality.repeated_words(words) == len(covered)
    assert quality.figures("é# b\n\né# b\n x".encode())[:5] == (5, 7, 2, 1, 0)
    long = " ".join(f"w{i}" for i in range(30))
    rows = [(i, f"Shared  LINE of these documents\n{long} {i}" if i % 2 else "shared line of these documents and a b c d e f g", None, "h", 1) for i in range(12)]
    rows += [(20 + i, "one line with ten words or more of its own here a\n", None, "h", 1) for i in range(6)]
    out = {r["doc_id"]: r for r in quality.assess(spark.createDataFrame(rows, DOCS), max_docs=4).collect()}
    assert out[1]["words_lost"] == 0 and out[3]["words_lost"] == 5 and out[3]["kept"]
    assert out[20]["kept"] and not out[21]["kept"] and not out[21]["base_failed"]
    told = quality.assess(odd).collect()
    assert len(told) == len(ODD) + 3 and quality.assess(none).count() == 0
    assert not any(r["kept"] for r in told if r["n_words"] < 10)


def test_shared_lines_go_by_the_share_of_a_host(spark):
    rows = []
    for host, n in (("small", 40), ("hot", 4000), (None, 40)):
        for i in range(n):
            lines = [f"w{i} own line of {j} words with its {i * 7 + j} names" for j in range(4)]
            lines += ["a line of a fifth of all"] * (i % 5 == 0) + ["a line of few"] * (i % 30 == 1)
            rows.append((len(rows), "\n".join(lines), None, host, 1))
        rows.append((len(rows), None, None, host, 1))
    lost = {r["doc_id"]: r["words_lost"] for r in quality.assess(spark.createDataFrame(rows, DOCS)).collect()}
    for start, n in ((0, 40), (41, 4000), (4042, 40)):
        assert [lost[start + i] for i in range(n)] == [7 * (i % 5 == 0 and i > 0) for i in range(n)]


def test_licenses(spark, odd, none):
    text = "The MIT License, mit license! Apache-License\nSPDX-License-Identifier: (GPL-2.0-only WITH Classpath-exception-2.0) OR MIT */"
    rows = spark.createDataFrame([(1, text, None, None, None), (2, "GNU General Public License", None, None, None)], DOCS)
    one, two = licenses.scan(rows).orderBy("doc_id").collect()
    assert (one["n_base"], one["first_word"], one["last_word"], one["base_labels"]) == (3, 1, 5, "apache,mit")
    assert one["labels"] == "apache,gpl,mit" and one["score"] == 1.0 and one["demand"] == 0
    assert (two["n_base"], two["first_word"], two["labels"], two["demand"]) == (1, 1, "gpl", None)
    assert licenses.evaluate("mit and (apache-2.0 or gpl-3.0+)")[1] == 0 and licenses.evaluate("mit and gpl-3.0")[1] == 2
    assert licenses.evaluate("or mit") is None and licenses.postfix(["(", "mit"]) is None and licenses.postfix(["mit", ")"]) is None
    assert licenses.scan(odd).count() == len(ODD) + 3 and licenses.scan(none).count() == 0


def joined_by_force(texts):
    sets = []
    for t in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append(frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset())
    group = list(range(len(texts)))
    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]) and group[i] != group[j]:
                low, high = sorted((group[i], group[j]))
                group = [low if g == high else g for g in group]
    return [len(s) for s in sets], group


def near_texts():
    rng, texts = random.Random(9), []
    for size in (4, 5, 7, 9, 14, 30, 60, 200, 400):
        for _ in range(4):
            words = [f"w{rng.randrange(10_000)}" for _ in range(size)]
            for edits in (0, 0, 1, 2, size // 30, size // 12):
                copy = list(words)
                for _ in range(edits):
                    copy[rng.randrange(len(copy))] = f"x{rng.randrange(10_000)}"
                texts.append(" ".join(copy))
    passage = " ".join(f"p{i}" for i in range(60))
    return texts + [f"{passage} {' '.join(f'q{rng.randrange(10_000)}' for _ in range(15))}" for _ in range(40)]


def test_jaccard_against_brute_force(spark, odd, none):
    texts = near_texts()
    sizes, group = joined_by_force(texts)
    rows = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCS)
    out = sorted(tuple(r) for r in jaccard.join(rows).collect())
    assert out == [(i, n, g) for i, (n, g) in enumerate(zip(sizes, group, strict=True))]
    odd_rows = jaccard.join(odd).collect()
    assert len(odd_rows) == len(ODD) + 3
    assert {r["component_id"] for r in odd_rows if r["doc_id"] in (5, 6)} == {5}
    assert all(r["component_id"] == r["doc_id"] for r in odd_rows if r["n_shingles"] == 0)
    assert jaccard.join(none).count() == 0


def test_sketches_lose_no_link():
    rng = np.random.default_rng(4)
    for size in (3, 40, 700):
        x = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64))
        y = np.unique(np.concatenate([x[: int(len(x) * 0.9)], rng.integers(0, 1 << 63, size // 12).astype(np.uint64)]))
        both = len(np.intersect1d(x, y))
        if 100 * both >= 75 * (len(x) + len(y) - both):
            assert jaccard.may_link(len(x), jaccard.sketch(x), len(y), jaccard.sketch(y))


def test_word_hashes_block_by_block():
    rng = random.Random(7)
    for sep in (" ", "\n", " \t "):
        text = sep.join(f"w{rng.randrange(5000)}" for _ in range(40_000)) + sep + "y" * 3 * jaccard.BLOCK + sep + "end"
        whole = jaccard._block_hashes(text.encode())
        assert len(whole) == 40_002 and (jaccard.word_hashes(text.encode()) == whole).all()


def test_chunks_of_counts_read_back():
    table = np.zeros(4 * jaccard.CHUNK, np.uint32)
    table[:300], table[3 * jaccard.CHUNK] = range(300), 0xFFFFFFFF
    sent = {at: jaccard._unpacked(jaccard._packed(part)) for at, part in jaccard._chunks(table).items()}
    assert list(sent) == [0, 3] and all((part == table[at * jaccard.CHUNK :][: jaccard.CHUNK]).all() for at, part in sent.items())
    steps = jaccard.levels(np.arange(2000, dtype=np.uint64))
    assert steps[0] == 0 and (np.diff(steps.astype(int)) >= 0).all() and jaccard.levels(np.array([2**60], np.uint64))[0] == 255


def test_components(spark):
    rng = random.Random(6)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1060)]
    group = {}
    for a, b in pairs:
        x, y = group.setdefault(a, {a}), group.setdefault(b, {b})
        if x is not y:
            x |= y
            for n in y:
                group[n] = x
    found = dict(tuple(r) for r in graph.components(spark.createDataFrame(pairs, "a long, b long")).collect())
    assert found == {n: min(g) for n, g in group.items() if len(g) > 1}


def test_multi_index_against_brute_force(spark):
    rng = np.random.default_rng(8)
    base = rng.normal(size=(300, 16))
    near = base[rng.integers(0, 60, 500)] + 0.08 * rng.normal(size=(500, 16))
    x = np.concatenate([base, near, base[:20]]).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(900, None), (901, [0.0] * 16), (902, [None] * 16), (903, [float("nan")] * 16), (904, [1.0])]
    out = {r["vec_id"]: r for r in neardup.link(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()}
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    links = (unit @ unit.T >= 0.95).sum(axis=1) - 1
    got = np.array([out[i]["n_links"] for i in range(len(x))])
    assert (got <= links).all() and got.sum() >= 0.95 * links.sum()
    assert all(out[i]["n_links"] == 0 and out[i]["component_id"] == i and out[i]["kept"] for i in range(900, 905))
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert neardup.link(empty).count() == 0


def test_multi_index_of_uneven_vectors(spark):
    rng = np.random.default_rng(8)
    spread = 1 / np.arange(1, 65)
    x = rng.normal(size=(1500, 64)) * spread
    x /= np.linalg.norm(x, axis=1)[:, None]
    away = rng.normal(size=x.shape) * spread
    away -= (away * x).sum(axis=1)[:, None] * x
    away /= np.linalg.norm(away, axis=1)[:, None]
    x = np.concatenate([x, 0.951 * x + np.sqrt(1 - 0.951**2) * away])
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    # 20 centroids a half.
    out = neardup.link(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), cell_rows=8).collect()
    links = (x @ x.T >= 0.95).sum() - len(x)
    assert 0.99 * links <= sum(r["n_links"] for r in out) <= links


def test_limits_that_pairs_need():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 8))
    books = neardup.codebook(x[:, :4], 6), neardup.codebook(x[:, 4:], 6)
    y = x + 0.3 * rng.normal(size=x.shape)
    for a, b, limit in zip(x, y, neardup.needed(x, y, books), strict=True):
        homes, reached = [], []
        for v in (a, b):
            (near1, one), (near2, two) = neardup.bounds(v[None, :4], books[0]), neardup.bounds(v[None, 4:], books[1])
            homes.append(int(near1[0]) * 6 + int(near2[0]))
            reached.append([{i * 6 + j for i, j in neardup.visited(one[0], two[0], w)} for w in (limit + 1e-9, limit - 1e-9)])
        low, high = sorted((0, 1), key=lambda n: homes[n])
        assert homes[high] in reached[low][0] and (homes[low] == homes[high] or limit < 1e-9 or homes[high] not in reached[low][1])
    assert neardup.step_for([(0, 3, 99), (0, 9, 1), (1, 5, 1)], 0.9) == 5 and neardup.step_for([(0, 3, 9), (0, 9, 1)], 0.95) == 9


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] and corpus_pipeline.ORACLE_SQL is None
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, sf_dir)
        assert kept.columns == docs.columns
    told = {r["doc_id"]: r["text"] for r in kept.collect()}
    # Brute force over the stages: all texts have a language; quality, then joins of what it left.
    good = [tuple(r) for r in docs.join(quality.assess(docs).where("kept"), "doc_id").select("doc_id", "text").orderBy("doc_id").collect()]
    _, group = joined_by_force([t for _, t in good])
    assert sorted(told) == [i for at, (i, _) in enumerate(good) if group[at] == at]
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.where("not restored").count() == 0 and {r[0] for r in out.select("doc_id").collect()} == set(told)


def shares_kept(order, blocks, weights):
    """Whether each source has had its shares to within less than a block after every slot; by fractions, slot by slot."""
    given = {s: Fraction(repr(w)) for s, w in weights.items()}
    due, placed = dict.fromkeys(blocks, Fraction(0)), collections.Counter()
    for s in order:
        placed[s] += 1
        room = Fraction(1)
        while room:
            live = [x for x in blocks if due[x] < blocks[x]]
            whole = sum(given[x] for x in live)
            step = min(room, *((blocks[x] - due[x]) * whole / given[x] for x in live))
            for x in live:
                due[x] += step * given[x] / whole
            room -= step
        if any(abs(placed[x] - due[x]) >= 1 for x in blocks):
            return False
    return placed == collections.Counter(blocks)


def test_mix_holds_the_given_weights(spark):
    weights = {f"s{i:02}": 1 / 3 if i == 0 else 2 / 57 for i in range(20)}
    blocks = {s: round(1000 * w) - int(s[1:]) % 3 for s, w in weights.items()}
    rows = spark.createDataFrame([(i, "t", None, s, 1) for s, n in blocks.items() for i in range(n)], DOCS)
    out = mixing.mix(rows, weights, block_rows=1).orderBy("mix_slot").collect()
    assert shares_kept([r["source"] for r in out], blocks, weights)


def test_mix_of_many_sources(spark):
    blocks = {f"s{i}": 40 if i == 0 else 1 + i % 2 for i in range(300)}
    rows = spark.createDataFrame([(i, "t", None, s, 1) for s, n in blocks.items() for i in range(n)], DOCS)
    out = mixing.mix(rows, block_rows=1).orderBy("mix_slot").collect()
    assert [r["mix_position"] for r in out] == list(range(sum(blocks.values())))
    assert shares_kept([r["source"] for r in out], blocks, {s: n**0.5 for s, n in blocks.items()})


def test_decoding_needs_no_transducer():
    vocabulary = pieces.Vocabulary.read(queries.TOKENIZER)
    transducer, outputs = pieces.Transducer(vocabulary), pieces.Outputs.of(vocabulary)
    for text in ("", " ", "a word  and\nanother", "\u2581 \U0001f600"):
        ids = np.frombuffer(transducer.encode(text), np.int32).tolist()
        assert outputs.text(ids) == text == transducer.decode(ids)


def test_encoding_stage_runs_one_python_step_at_a_time(spark):
    import corpus_pipeline

    docs = spark.createDataFrame([(1, "en", "s", "a text"), (2, None, None, None), (3, "en", "s", "")], "doc_id long, lang string, source string, text string")
    out = corpus_pipeline.encoding_stage(spark, docs, "")
    assert out._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert sorted((r.doc_id, r.restored) for r in out.collect()) == [(1, True), (2, True), (3, True)]


def test_decoding_drops_what_encoding_remembers(spark, monkeypatch):
    vocabulary = pieces.Vocabulary.read(queries.TOKENIZER)
    small = pieces.Transducer(vocabulary, 40)
    texts = [" ".join(f"word{i * j}" for i in range(60)) for j in range(1, 6)]
    assert [small.encode(t) for t in texts] == [pieces.Transducer(vocabulary).encode(t) for t in texts]
    assert max(map(len, (small.states, small.words, small.weights))) <= 40 and len(small.chunks) <= 10
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)

    coded = pieces.encode(docs, queries.TOKENIZER, memo=40).localCheckpoint()
    back = pieces.decode(coded, queries.TOKENIZER, into="again", forget=True)
    assert back.where("again = text").count() == len(texts)
    asked = []
    monkeypatch.setattr(corpus_pipeline.pieces, "decode", lambda *a, f=pieces.decode, **b: asked.append(b.get("forget")) or f(*a, **b))
    monkeypatch.setattr(corpus_pipeline.pieces, "encode", lambda *a, f=pieces.encode, **b: asked.append(b.get("memo")) or f(*a, **b))
    rows = docs.selectExpr("doc_id", "'en' lang", "'s' source", "text")
    assert corpus_pipeline.encoding_stage(spark, rows, "").where("not restored").count() == 0
    assert asked == [pieces.MEMO // 2, True]
