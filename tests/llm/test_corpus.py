"""The corpus operators on small fixtures, against brute force."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from conftest_rows import BASE, ROWS
from pyspark.sql import functions as F

from sazonal.llm import (
    bin_completion, class_ngram, exact_dedup, forest_search, html_extract, license_scan, lsh_forest,
    neighbour_quality, pivotal_mix, url_filter,
)
from sazonal.llm.common import WORD_BYTES, coded_words, distinct
from sazonal.llm.components import components

SF = "/root/testdata/sf0.001"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text))


def fold(doc_id, n):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % n


# Exact deduplication


@pytest.mark.parametrize("weak", [False, True])
def test_exact_dedup_keeps_the_largest_id(docs, weak):
    # A digest of two bits makes different texts collide; whole texts tell them apart.
    digest = (lambda c: F.substring(F.unhex(F.sha2(c, 256)), 1, 1)) if not weak else (
        lambda c: F.crc32(c.cast("binary")).bitwiseAND(3).cast("string").cast("binary"))
    found = exact_dedup.deduplicate(docs, digest=digest)
    groups = defaultdict(list)
    for doc_id, text, *_ in ROWS:
        groups[lower(text)].append(doc_id)
    want = Counter()
    for ids in groups.values():
        keep = max((i for i in ids if i is not None), default=None)
        for i in ids:
            want[i, keep, len(ids)] += 1
    rows = found.rows.collect()
    assert Counter((r.id, r.keep_id, r.group_size) for r in rows) == want
    assert sum(r.kept for r in rows) == len(groups)
    assert found.documents.columns == docs.columns
    assert Counter(lower(r.text) for r in found.documents.collect()) == Counter(groups.keys())


def test_exact_dedup_state_outlives_a_call(files, tmp_path):
    schema = "doc_id long, text string"
    state = str(tmp_path)
    exact_dedup.deduplicate(files([(1, "a"), (5, "b")], schema), state_dir=state)
    later = exact_dedup.deduplicate(files([(2, "A"), (3, "c")], schema), state_dir=state)
    assert {(r.id, r.keep_id, r.group_size) for r in later.rows.collect()} == {
        (1, 2, 2), (5, 5, 1), (2, 2, 2), (3, 3, 1)
    }


def test_exact_dedup_tells_texts_of_earlier_calls_apart(files, tmp_path):
    schema, state = "doc_id long, text string", str(tmp_path)
    same = lambda c: F.lit("x").cast("binary")
    exact_dedup.deduplicate(files([(1, "a"), (7, None)], schema), digest=same, state_dir=state)
    later = exact_dedup.deduplicate(files([(2, "b"), (3, "A")], schema), digest=same, state_dir=state)
    assert {(r.id, r.keep_id, r.group_size, r.kept) for r in later.rows.collect()} == {
        (1, 3, 2, False), (3, 3, 2, True), (2, 2, 1, True), (7, 7, 1, True)
    }
    assert {r.doc_id for r in later.documents.collect()} == {2, 3}


def test_exact_dedup_counts_a_repeated_batch_once(files, tmp_path):
    schema, state = "doc_id long, text string", str(tmp_path)
    exact_dedup.deduplicate(files([(9, "a")], schema), state_dir=state, batch="first")
    rows = files([(1, "a"), (2, "b")], schema)
    for _ in range(2):
        found = exact_dedup.deduplicate(rows, state_dir=state, batch="second")
        assert sorted((r.id, r.keep_id, r.group_size, r.kept) for r in found.rows.collect()) == [
            (1, 9, 2, False), (2, 2, 1, True), (9, 9, 2, True)
        ]
        assert [r.doc_id for r in found.documents.collect()] == [2]


def test_exact_dedup_of_nothing(no_docs):
    found = exact_dedup.deduplicate(no_docs)
    assert found.rows.count() == 0 and found.documents.count() == 0


# Near-duplicates


def shingles(text):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))


def brute_components(rows):
    sets = [shingles(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 75 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = defaultdict(lambda: math.inf)
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)] = min(least[find(i)], math.inf if doc_id is None else doc_id)
    return Counter(
        (doc_id, len(sets[i]), None if least[find(i)] == math.inf else least[find(i)])
        for i, (doc_id, _) in enumerate(rows)
    )


def test_near_duplicates_of_odd_rows(docs):
    got = lsh_forest.near_duplicates(docs).collect()
    assert Counter((r.id, r.n_shingles, r.component_id) for r in got) == brute_components([r[:2] for r in ROWS])
    assert all(r.kept == (r.id == r.component_id) for r in got)


def test_near_duplicates_in_a_crowd(files):
    draw = random.Random(5)
    base = [f"w{draw.randrange(400)}" for _ in range(120)]
    rows = []
    for i in range(300):
        copy = list(base)
        for _ in range(draw.choice([0, 1, 2, 3, 5, 8])):
            copy[draw.randrange(len(copy))] = f"x{draw.randrange(10**6)}"
        rows.append((i, " ".join(copy)))
    got = lsh_forest.near_duplicates(files(rows, "doc_id long, text string")).collect()
    assert Counter((r.id, r.n_shingles, r.component_id) for r in got) == brute_components(rows)


def test_near_duplicates_lose_no_link_in_a_crowd_near_the_threshold(files):
    """Unlinked texts that share a long passage, and pairs just above the threshold among them."""
    def text(passage, rest):
        return " ".join([f"p{i}" for i in range(passage)] + [f"r{rest}x{i}" for i in range(100 - passage)])

    rows = [(i, text(84 + i % 3, i)) for i in range(500)]
    for i in range(500, 580, 2):
        own = text(84, i).split()
        rows += [(i, " ".join(own)), (i + 1, " ".join(own[:87] + [f"s{i}x{k}" for k in range(13)]))]
    sets = {i: shingles(body) for i, body in rows}
    alike = {b: len(sets[0] & sets[b]) / len(sets[0] | sets[b]) for b in range(1, 500)}
    assert all(0.68 < x < 0.75 for x in alike.values()), (min(alike.values()), max(alike.values()))
    assert all(0.75 <= len(sets[i] & sets[i + 1]) / len(sets[i] | sets[i + 1]) < 0.78 for i in range(500, 580, 2))
    got = lsh_forest.near_duplicates(files(rows, "doc_id long, text string")).collect()
    assert Counter((r.id, r.n_shingles, r.component_id) for r in got) == brute_components(rows)


def test_near_duplicates_of_nothing(no_docs):
    assert lsh_forest.near_duplicates(no_docs).count() == 0
    assert lsh_forest.first_of_each(no_docs).columns == no_docs.columns


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 201)}, **{1000 + i: 1000 for i in range(1, 300)}}


# Mixing


def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        rest = [s for s in order if s not in fixed]
        left = total - sum(fixed.values())
        shares = {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest}
        over = [s for s in rest if shares[s] > 3 * sizes[s] + 1e-9]
        if not over:
            return {**fixed, **shares}
        fixed |= {s: 3 * sizes[s] for s in over}


def test_mix_meets_its_targets_and_agrees_on_reruns(files):
    draw = random.Random(3)
    rows = [
        (i, "w " * draw.randrange(0, 40), draw.choice(["a", "b", "c", "d", None]) if i % 9 else "tiny")
        for i in range(9000)
    ] + [(9001, "w " * 5, "rare")]
    table = files(rows, "doc_id long, text string, source string")
    got = pivotal_mix.mix(table).collect()
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(words(text))
    want = brute_targets(sizes)
    taken = Counter()
    for r in got:
        assert r.size == len(words(rows[r.id][1])) if r.id < 9000 else r.size == 5
        assert 0 <= r.copies <= 3 and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
        taken[r.source] += r.copies * r.size
    assert len(got) == len(rows)
    assert all(abs(taken[s] - want[s]) <= 40 for s in want)
    again = pivotal_mix.mix(table.repartition(3)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, again), key=str)
    copies = Counter(r.doc_id for r in pivotal_mix.mixed_documents(table).collect())
    assert copies == {r.id: r.copies for r in got if r.copies}


def test_mix_of_odd_rows(docs, no_docs):
    got = pivotal_mix.mix(docs).collect()
    assert sum(r.rows for r in got) == len(ROWS)
    assert pivotal_mix.mixed_documents(docs).columns == docs.columns
    assert pivotal_mix.mix(no_docs).count() == 0


# Packing


def test_packing_is_whole_and_gapless(docs, no_docs):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    got = bin_completion.pack(docs, path).collect()
    by_row, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        by_row[r.row_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    ids = Counter()
    for doc_id, text, *_ in ROWS:
        line = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        pieces = [line[i : i + 2048] for i in range(0, len(line), 2048)]
        ids[doc_id, tuple((len(p), zlib.crc32(np.array(p, "<u4").tobytes())) for p in pieces)] += 1
    found = Counter()
    for pieces in by_row.values():
        pieces.sort(key=lambda r: r.piece)
        assert [r.start for r in pieces] == [2048 * i for i in range(len(pieces))]
        found[pieces[0].doc_id, tuple((r.length, r.ids_crc32) for r in pieces)] += 1
    assert found == ids
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert bin_completion.pack(no_docs, path).count() == 0


def test_words_give_the_tokenizers_ids():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    whole, fast = Tokenizer.from_file(path), bin_completion.WordEncoder(path)
    for text in ("It's I'M don't a<|endoftext|>b", "ÀÉ ﬁ x² İ ß!! Ω Σ ΑΣ é \x1c z", "12 a1b2 'tis '' ,,,a", "%%% x### (y)", ""):
        ids = whole.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(fast.encode(text.encode()), "<u4").tolist() == ids


@pytest.mark.parametrize("seed", range(6))
def test_bin_completion_against_all_packings(seed):
    draw = random.Random(seed)
    items = sorted((draw.randrange(5, 60) for _ in range(9)), reverse=True)

    def least(i, rooms):
        if i == len(items):
            return len(rooms)
        best, seen = least(i + 1, rooms + [100 - items[i]]), set()
        for k, room in enumerate(rooms):
            if room >= items[i] and room not in seen:
                seen.add(room)
                best = min(best, least(i + 1, rooms[:k] + [room - items[i]] + rooms[k + 1 :]))
        return best

    patterns = bin_completion.complete_bins(Counter(items), 100)
    used = Counter()
    for pattern, times in patterns:
        assert sum(pattern) <= 100
        for size in pattern:
            used[size] += times
    assert used == Counter(items)
    assert sum(times for _, times in patterns) == least(0, [])


# Class n-grams


def test_class_model_against_counts(spark, docs, no_docs):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    got = class_ngram.score(table).collect()
    train, ends = Counter(), 0
    texts = {r.doc_id: words(r.text) for r in table.collect()}
    for doc_id, line in texts.items():
        if fold(doc_id, 10):
            train.update(line)
            ends += 1
    n, v = sum(train.values()) + ends, len(train) + 1
    assert len(got) == len(texts)
    for r in got:
        line = texts[r.doc_id]
        assert r.held_out == (fold(r.doc_id, 10) == 0)
        assert (r.n_tokens, r.train_tokens) == (len(line) + 1, n)
        assert r.n_known == sum(train[w] > 0 for w in line) + 1
        base = sum(math.log10((c + 0.1) / (n + 0.1 * (v + 1))) for c in [*(train[w] for w in line), ends])
        assert r.base_score == pytest.approx(base)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    odd = class_ngram.score(docs).collect()
    assert len(odd) == len(ROWS) and all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in odd)
    assert class_ngram.score(no_docs).count() == 0


def test_rare_words_are_placed_by_their_neighbours(spark):
    # Words of at most 8 occurrences among some 110,000 tokens are no items; all end alike, but
    # those of one half stand in other surroundings than those of the other.
    draw = random.Random(3)
    texts = []
    for i in range(400):
        filler = [f"f{2 * at + i % 2}" for at in range(100)]
        line = []
        for j in range(2):
            line += [*draw.choices(filler, k=150), f"w{(i // 2 * 2 + j) % 50 * 2 + i % 2}ing"]
        texts.append(" ".join([*line, draw.choice(filler)]))
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model, found, _ = class_ngram.fit(table)
    rows = {bytes(r["word"]).decode(): r for r in found.collect()}
    placed = {w: r for w, r in rows.items() if w.endswith("ing") and r.n >= class_ngram.LEAST}
    assert len(placed) > 60
    assert max(r.n for r in placed.values()) < class_ngram.ITEM_SHARE * model.n_tokens
    kinds = [{r["class"] for w, r in placed.items() if int(w[1:-3]) % 2 == side} for side in (0, 1)]
    assert not kinds[0] & kinds[1]


def test_class_model_scores_against_plain_counts(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    lines = {r.doc_id: [w.encode() for w in words(r.text)] for r in table.collect()}
    train = Counter(w for doc_id, line in lines.items() if fold(doc_id, 10) for w in line)
    _, found, _ = class_ngram.fit(table)
    kinds = {bytes(r["word"]): r["class"] for r in found.collect()}
    assert {bytes(r["word"]): r.n for r in found.collect()} == train
    texts = class_ngram._texts(table, "doc_id", "text")
    endings = class_ngram.vocabulary(texts)[1]
    k = class_ngram.CLASSES
    paths = {
        doc_id: [0, *(kinds.get(w, endings[zlib.crc32(w[-3:]) % class_ngram.ENDINGS]) for w in line), 0]
        for doc_id, line in lines.items()
    }
    counts, mass = np.zeros((k, k)), np.zeros(k)
    for doc_id, path in paths.items():
        if fold(doc_id, 10):
            np.add.at(counts, (path[:-1], path[1:]), 1)
    for w, n in train.items():
        mass[kinds[w]] += n + 0.1
    mass[np.unique(endings)] += 0.1
    steps = class_ngram.log_steps(counts)
    for r in class_ngram.score(table).collect():
        path = paths[r.doc_id]
        want = steps[path[:-1], path[1:]].sum()
        want += sum(math.log10((train[w] + 0.1) / mass[c]) for w, c in zip(lines[r.doc_id], path[1:]))
        assert r.score == pytest.approx(want)


def test_numbered_lines_add_up_to_plain_counts(spark):
    draw = random.Random(21)
    lines = [" ".join(draw.choices(["on", "off", "ab", "running", "sing", "king"], k=draw.randrange(7))) for _ in range(80)]
    items = {b"on": 1 + class_ngram.ENDINGS, b"off": 2 + class_ngram.ENDINGS}

    def item(word):
        return items.get(word, 1 + zlib.crc32(word[-3:]) % class_ngram.ENDINGS)

    want, done = Counter(), (np.zeros(0, np.int64), np.zeros(0, np.int64))
    for part in (lines[:30], lines[30:31], [""], lines[31:]):
        words, codes, starts = coded_words(pa.array([text.encode() for text in part], pa.binary()), WORD_BYTES)
        got = class_ngram._with_ends(class_ngram._items(words, items)[codes], starts)
        plain = [0, *(code for text in part for code in (*map(item, text.encode().split()), 0))]
        assert got.tolist() == plain
        want.update(zip(plain, plain[1:]))
        done = class_ngram._added(*done, *distinct(got[:-1] * class_ngram.PAIR + got[1:]))
    assert dict(zip((divmod(key, class_ngram.PAIR) for key in done[0].tolist()), done[1].tolist())) == want


def test_words_are_looked_up_as_a_whole():
    class Whole(dict):
        def get(self, *_):
            raise AssertionError("words are looked up one by one")

    class Asked(class_ngram.Alive):
        def holds_keys(self, keys):
            asked.extend(keys)
            return super().holds_keys(keys)

    draw, asked = np.random.default_rng(17), []
    plain = [b"", *dict.fromkeys(bytes(draw.integers(97, 102, draw.integers(1, 6)).tolist()) for _ in range(400))]
    words = pa.array(plain, pa.binary())
    items = {word: 1 + class_ngram.ENDINGS + at for at, word in enumerate(plain[::7])}
    want = [items.get(word, 1 + zlib.crc32(word[-3:]) % class_ngram.ENDINGS) for word in plain]
    assert class_ngram._items(words, Whole(items)).tolist() == want
    assert class_ngram._items(words[3:9], Whole()).tolist() == [
        1 + zlib.crc32(word[-3:]) % class_ngram.ENDINGS for word in plain[3:9]
    ]
    assert len(class_ngram._items(words[:0], Whole(items))) == 0
    # Only words whose occurrences do not say it are asked for, as Spark's filter has them.
    alive = Asked(draw.integers(0, 256, 1 << 8).astype(np.uint8))
    n = draw.integers(1, 2 * class_ngram.LEAST, len(plain))
    few = [word for word, times in zip(plain, n) if times < class_ngram.LEAST]
    held = class_ngram._held(alive, words, n)
    assert asked == [b"\0" + word for word in few]
    passed = dict(zip(few, alive.holds(b"", few).tolist()))
    assert held.tolist() == [passed.get(word, True) for word in plain] and 0 < sum(passed.values()) < len(few)
    numbers, known = {}, pa.array([], pa.binary())
    for part in (plain[:90], plain[40:200], [], plain[150:]):
        known, got = class_ngram._numbered(known, pa.array(part, pa.binary()))
        assert got.tolist() == [numbers.setdefault(word, len(numbers)) for word in part]
    assert known.to_pylist() == list(numbers)


def test_words_are_placed_across_batches(spark):
    # Rows of one word lie in several batches, which hold two rows each.
    draw, k = np.random.default_rng(9), 4
    counts = draw.poisson(9, (k, k)).astype(float) + 1
    classes = np.r_[0, draw.integers(1, k, class_ngram.ENDINGS)]
    sums, rows = {}, []
    for word in (b"one", b"two", b"three", b"four", b"five"):
        for _ in range(draw.integers(1, 8)):
            codes = draw.choice(2 * k + 1, 4, replace=False).tolist()
            times = draw.integers(1, 5, 4).tolist()
            rows.append((bytearray(word), codes, times))
            np.add.at(sums.setdefault(word, np.zeros(2 * k + 1)), codes, times)
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        table = spark.createDataFrame(rows, "word binary, codes array<smallint>, times array<int>").repartition(5)
        got = class_ngram.placed_words(table, classes, counts).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    steps, mass = class_ngram.log_steps(counts), np.log10(counts.sum(axis=0))
    want = {}
    for word, codes in sums.items():
        if codes[:k].sum() + codes[-1] >= class_ngram.LEAST:
            own = classes[[1 + zlib.crc32(word[-3:]) % class_ngram.ENDINGS]]
            want[word] = int(class_ngram.best_places(own, codes[None, :], steps, mass)[0])
    assert want and {bytes(row[0]): row[1] for row in got} == want and len(got) == len(want)


def test_places_are_the_likeliest():
    draw = np.random.default_rng(4)
    k, n = 6, 30
    steps = class_ngram.log_steps(draw.poisson(3, (k, k)).astype(float))
    mass = draw.normal(size=k)
    codes = draw.poisson(1, (n, 2 * k + 1)).astype(float)
    own = draw.integers(1, k, n)
    got = class_ngram.best_places(own, codes, steps, mass)
    for row, best in zip(codes, got):
        def likely(c):
            total = sum(row[j] * steps[c, j] + row[k + j] * steps[j, c] for j in range(k))
            return total + row[2 * k] * steps[c, c] - (row[:k].sum() + row[2 * k]) * mass[c]

        assert likely(best) == pytest.approx(max(map(likely, range(1, k))))


def test_exchange_step_finds_the_best_class():
    draw = np.random.default_rng(1)
    n, k = 20, 5
    pairs = draw.poisson(2, (n, n)).astype(float)
    classes = np.r_[0, 1 + draw.integers(0, k - 1, n - 1)]

    def counts(of):
        out = np.zeros((k, k))
        np.add.at(out, (of[:, None].repeat(n, 1), of[None].repeat(n, 0)), pairs)
        return out

    for item in range(1, n):
        after, before = np.flatnonzero(pairs[item]), np.flatnonzero(pairs[:, item])
        best, table = class_ngram.best_class(
            item, after, pairs[item, after], before, pairs[before, item], classes, counts(classes)
        )
        reached = []
        for to in range(1, k):
            moved = classes.copy()
            moved[item] = to
            reached.append(class_ngram.likelihood(counts(moved)))
            if to == best:
                assert np.allclose(counts(moved), table)
        assert reached[best - 1] == pytest.approx(max(reached))


# Neighbours


def test_forest_recall_ties_and_odd_vectors(files):
    draw = np.random.default_rng(2)
    rows = [(i, draw.normal(size=8).round(3).tolist()) for i in range(600)]
    rows += [(600 + i, [1.0] * 8) for i in range(200)]
    odd = [(900, None), (920, [0.0] * 8), (940, [float("nan")] + [1.0] * 7), (960, [1.0, None] + [1.0] * 6),
           (980, [float("inf")] * 8), (1000, [1.0, 2.0]), (None, [1.0] * 8)]
    table = files(rows + odd, "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for r in forest_search.nearest(table, F.col("id") % 20 == 0).collect():
        got[r.query_id].append((r.rank, r.id, r.score))
    vectors = {i: np.array(v) for i, v in rows}
    hits = 0
    assert set(got) == {i for i in vectors if i % 20 == 0}
    for q, found in got.items():
        found.sort()
        assert [rank for rank, _, _ in found] == list(range(1, 21))
        for _, i, score in found:
            assert score == pytest.approx(float(vectors[q] @ vectors[i]), abs=1e-9)
        want = sorted(((-round(float(vectors[q] @ v), 9), i) for i, v in vectors.items() if i != q))[:20]
        hits += len({i for _, i in want} & {i for _, i, _ in found})
    assert hits / (20 * len(got)) >= 0.9
    few = files(rows[:5], "vec_id long, embedding array<double>")
    assert forest_search.nearest(few, F.col("id") == 0).count() == 4
    assert forest_search.nearest(files([], "vec_id long, embedding array<double>"), F.col("id") == 0).count() == 0


@pytest.mark.parametrize("n", [10, 30])
def test_forest_fills_the_ranks_of_small_tables(files, n):
    draw = np.random.default_rng(n)
    rows = [(i, draw.normal(size=64).tolist()) for i in range(n)]
    table = files(rows, "vec_id long, embedding array<double>")
    found = Counter(r.query_id for r in forest_search.nearest(table, F.col("id") >= 0).collect())
    assert found == dict.fromkeys(range(n), min(20, n - 1))


def test_quality_votes(spark, docs, no_docs, files):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = neighbour_quality.fit_quality(table, neighbour_quality.training_rows(labels))
    scored = neighbour_quality.score_quality(table, model, columns=["doc_id"]).select("row.doc_id", "quality_score")
    held = scored.join(labels, "doc_id").where("crc32(cast(doc_id as string)) % 3 = 1").collect()
    right = sum((r.quality_score >= 0.5) == (r.quality == 1) for r in held)
    assert right / len(held) > 0.95
    odd = neighbour_quality.score_quality(docs, model).collect()
    assert len(odd) == len(ROWS) and all(0 <= r.quality_score <= 1 for r in odd)
    assert neighbour_quality.score_quality(no_docs, model).count() == 0
    none = neighbour_quality.fit_quality(docs, files([], "doc_id long, quality int"))
    assert {r.quality_score for r in neighbour_quality.score_quality(docs, none).collect()} == {0.5}


# Pages


def test_url_rules_and_votes(files):
    urls = [
        (1, "https://A.Example.NET/en/1?x#y", "a.example.net", "/en/1", "example.net/en/", "allow"),
        (2, "http://example.net", "example.net", "", None, "allow"),
        (3, "http://b.net/x", "b.net", "/x", "net/", "block"),
        (4, "http://x.example.com/de/5.html", "x.example.com", "/de/5.html", "example.com/de/", "block"),
        (5, "http://q.org/fr/", "q.org", "/fr/", "org/fr/", "allow"),
        (6, "http://notexample.com/de/?q=://z", "notexample.com", "/de/", None, None),
        (7, None, "", "", None, "allow"), (8, "no scheme/net/", "", "", None, "allow"), (8, "", "", "", None, "allow"),
        (9, "https://www.casino-palace.example.com/en/1", "www.casino-palace.example.com", "/en/1", None, "block"),
        (10, "https://meadow.example.com/en/1", "meadow.example.com", "/en/1", None, "allow"),
        (11, "http://long.example.com/" + "a" * 50_000, "long.example.com", "/" + "a" * 50_000, None, None),
    ]
    table = files([u[:2] + ("h",) for u in urls], "page_id long, url string, host string")
    got = Counter((r.page_id, r.host, r.path, r.rule) for r in url_filter.judge_urls(table).collect())
    assert got == Counter((u[0], *u[2:5]) for u in urls)
    verdicts = {r.page_id: r.verdict for r in url_filter.judge_urls(table).collect()}
    assert all(verdicts[u[0]] == u[5] for u in urls if u[5] and u[0] not in (2, 7, 8))
    assert url_filter.judge_urls(files([], "page_id long, url string")).count() == 0


PAGE = """<html><body><div class="site-header"><p>Welcome, to, our, site, with, many, commas.</p></div>
<nav><a href=x>Home</a></nav><div id="cookie-notice">We use cookies, accept, please, now, yes.</div>
<div class="wrap"><div class="content"><h2>Title &amp; more</h2><p>First paragraph, with text, to count &eacute;.
<p>Second <a href=1>link</a> text<script>x("</p>")</script>, again long enough, for us.<ul><li>one<li>two</ul>
<div class="share">share me</div></div><div class="sidebar"><p>Side text, long, long, long, here, and, more.</p></div>
<section id="comments"><p>A reader comment, which is long, and says things.</p></section></div>
<form><p>enter</p></form><footer>c 2020</footer>"""


def test_html_extraction(files):
    want = "Title & more\n\nFirst paragraph, with text, to count é.\n\nSecond link text, again long enough, for us.\n\none\n\ntwo"
    deep = "<div>" * 5000 + "<p>deep, down, here.</p>"
    rows = [(1, "u", PAGE, "t"), (1, "u", PAGE, "t"), (2, None, None, None), (3, "u", "", "t"), (4, "u", "<nav>x</nav>", "t"),
            (5, "u", deep, "t"), (6, "u", "<article>" + "<p>word, word.</p>" * 9000, "t")]
    table = files(rows, "page_id long, url string, html string, text string")
    got = sorted((r.page_id, r.text, r.n_chars) for r in html_extract.extract_text(table).collect())
    long = "\n\n".join(["word, word."] * 9000)
    texts = [(1, want), (1, want), (2, ""), (3, ""), (4, ""), (5, "deep, down, here."), (6, long)]
    assert got == [(i, t, len(t)) for i, t in texts]
    assert html_extract.extract_text(files([], "page_id long, url string, html string")).count() == 0


LONG = [f"Sentence {i} of the article, which goes on, as articles do, for quite some words more." for i in range(9)]
PROSE = "".join(f"<p>{x}</p>" for x in LONG)
LINKS = '<ul><li><a href="/a">Other page</a></li><li><a href="/b">One more page</a></li></ul>'


@pytest.mark.parametrize("page, want", [
    *[(f'<div class="{name}">{PROSE}</div>', LONG) for name in
      ("content has-sidebar", "no-sidebar", "post-share", "related-story", "search-result", "modal", "comments")],
    (f"<form>{PROSE}<input></form>", LONG),
    (f'<div class="menu">{PROSE}</div><p>A short, lone line.</p>', [*LONG, "A short, lone line."]),
    (f"<div><h1>Title</h1><div class=body>{PROSE}</div></div>", ["Title", *LONG]),
    (f"<div><div>{PROSE}</div><h2>Part</h2><p>Short one</p><div>{PROSE}</div></div>", [*LONG, "Part", "Short one", *LONG]),
    (f"<section><div>{PROSE}</div></section><section><div>{PROSE}</div></section>", LONG * 2),
    (f'<div class="sidebar">{LINKS}</div><div>{PROSE}</div><div class="related-content">{LINKS}</div>'
     f'<div class="comments">{PROSE}</div><form><p>Your name</p></form>', LONG),
])
def test_html_keeps_whole_articles(page, want):
    assert html_extract.main_blocks(f"<html><body>{page}</body></html>") == want


def test_licenses_are_inherited_from_the_nearest_directory(files):
    mit = "Released under the MIT License."
    rows = [
        (1, "a/LICENSE", mit), (2, "a/b/c/x.py", "print"), (3, "a/b/LICENSE", "Licensed under CC BY-NC 4.0."),
        (4, "a/y.py", "# Licensed under the Apache License, Version 2.0.\n" + "code words here\n" * 300),
        (5, "z/y.py", "nothing"), (6, None, mit), (7, "a/n.py", None), (7, "a/n.py", ""), (8, "top", "x " * 50_000),
        (9, "p/k", "lİcensed under the apache lİcense"), (10, "q/k", "LICENSED UNDER THE APACHE LICENSE, VERSION 2.0"),
    ]
    table = files([r + ("k",) for r in rows], "id long, path string, text string, license string")
    got = license_scan.scan_licenses(table, F.col("id"), F.col("path"), F.col("text")).collect()
    assert Counter((r.id, r.license, r.via, r.origin) for r in got) == Counter([
        (1, "MIT", "header", None), (2, "CC-BY-NC-4.0", "directory", "a/b/"), (3, "CC-BY-NC-4.0", "header", None),
        (4, "Apache-2.0", "header", None), (5, None, None, None), (6, "MIT", "header", None),
        (7, "MIT", "directory", "a/"), (7, "MIT", "directory", "a/"), (8, None, None, None),
        (9, None, None, None), (10, "Apache-2.0", "header", None),
    ])
    empty = files([], "id long, path string, text string")
    assert license_scan.scan_licenses(empty, F.col("id"), F.col("path"), F.col("text")).count() == 0


# The pipeline


def test_workers_hold_no_words_of_earlier_stages(spark, docs, files):
    labels = files([(1, 1), (2, 0)], "doc_id long, quality int")
    model = neighbour_quality.fit_quality(docs, labels)
    assert neighbour_quality.score_quality(docs, model).count() == lsh_forest.near_duplicates(docs).count()

    def held(batches):
        from sazonal.llm import lsh_forest, neighbour_quality

        for _ in batches:
            pass
        yield pa.RecordBatch.from_pydict({"n": [len(lsh_forest._WORDS) + len(neighbour_quality._SHAPE_OF)]})

    assert {r.n for r in spark.range(0, 64, 1, 32).mapInArrow(held, "n long").collect()} == {0}


def test_pipeline_against_its_parts(spark):
    import corpus_pipeline
    from sazonal.llm.common import stored

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, docs
    counts = []
    for name, stage in corpus_pipeline.STAGES[:3]:
        kept = stored(stage(spark, kept, SF), name)
        assert kept.columns == columns
        counts.append([(r.doc_id, r.text) for r in kept.collect()])
    quality, exact, near = counts
    best = {}
    for doc_id, text in quality:
        best[lower(text)] = max(doc_id, best.get(lower(text), -1))
    assert {i for i, _ in exact} == set(best.values())
    left = {i for (i, _, c) in brute_components(exact) if i == c}
    assert {i for i, _ in near} == left
    rows = corpus_pipeline.run(spark, SF).collect()
    per_sequence = Counter()
    for r in rows:
        assert r.doc_id in left
        per_sequence[r.sequence_id] += r.length
    assert max(per_sequence.values()) <= 2048
