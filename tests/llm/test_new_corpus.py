"""Mixture packing, prefix refinement and phrase mining on small fixtures, against brute force."""

import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from conftest_rows import DOCS, ROWS
from pyspark.sql import functions as F

from sazonal.llm import mixture_packing, phrase_trie, prefix_refinement
from sazonal.llm.common import WORD_BYTES, coded_words, words_of
from sazonal.llm.mixture_packing import Queue, Sequences

PATH = public_tokenizers.path("word_bpe_49k.json")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# Mixture packing


def round_robin(left, right, left_weight, right_weight):
    """Which side a node serves, quantum by quantum, keeping the deficits as it goes."""
    both, deficit, out = left_weight + right_weight, 0, []
    while left or right:
        # Twice the left side's deficit in parts of both weights.
        deficit += 2 * left_weight
        first = (deficit >= both or not right) and left > 0
        out.append(first)
        if first:
            left -= 1
        else:
            right -= 1
        if left and right:
            deficit -= 2 * both * first
    return out


@pytest.mark.parametrize("sizes, weights", [((7, 5), (7, 5)), ((1, 40), (1, 40)), ((9, 9), (5, 2)),
                                            ((30, 4), (1, 3)), ((0, 6), (0, 6)), ((6, 5), (0, 1)), ((3, 8), (1, 0))])
def test_deficits_are_known_without_serving(sizes, weights):
    served = round_robin(*sizes, *weights)
    for right in (False, True):
        own, other = (sizes[1], sizes[0]) if right else sizes
        w, v = (weights[1], weights[0]) if right else weights
        queue = Queue([(right, own, other, w, v, 0)], own)
        turns = [at for at, first in enumerate(served) if first != right]
        assert [queue.turn(nth) for nth in range(own)] == turns
        for n in range(len(served) + 1):
            assert queue.share(0, n)[1] == sum(1 for t in turns if t < n)


def test_sequences_end_in_powers_of_two():
    sequences = Sequences(3 * 4096 + 1027, 4096)
    lengths = Counter()
    for number, offset, n in sequences.cut(0, 3 * 4096 + 1027):
        assert offset == 0
        lengths[number] += n
    assert list(lengths.values()) == [4096] * 3 + [1024, 2, 1]


def ids_of(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids + [2]


def check_packing(rows, given, window):
    """Every id of every row lies in one piece, and sequences have no gaps."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r.length * 4 == len(r.ids) and r.length > 0
        pieces[r.doc_id, r.doc_tokens].append((r.start, bytes(r.ids)))
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, n in sorted(parts):
            assert offset == end
            end += n
        assert end == window or end & end - 1 == 0
    got = Counter()
    for (doc_id, tokens), parts in pieces.items():
        text = b"".join(ids for _, ids in sorted(parts))
        got[doc_id, tokens, zlib.crc32(text)] += 1
        assert len(text) % (4 * tokens) == 0
    want = Counter()
    for doc_id, text, *_ in given:
        ids = ids_of(text)
        want[doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] = 1
    return got, want


def test_mixture_of_odd_rows(files):
    rows = [r for at, r in enumerate(ROWS) if r[0] != 6 or at == 6]
    docs = files(rows, DOCS)
    got, want = check_packing(mixture_packing.pack_mixture(docs, PATH, window=64, quantum=8).collect(), rows, 64)
    assert got == want


def test_mixture_of_repeated_rows(files):
    rows = [(6, "one two three", "a")] * 5
    got = mixture_packing.pack_mixture(files(rows, "doc_id long, text string, source string"), PATH, window=8, quantum=4).collect()
    assert sum(r.length for r in got) == 5 * 4
    assert Counter((r.start, r.length) for r in got if r.start == 0) and all(r.doc_tokens == 4 for r in got)


def test_mixture_of_nothing(no_docs):
    assert mixture_packing.pack_mixture(no_docs, PATH).count() == 0
    with pytest.raises(ValueError):
        mixture_packing.pack_mixture(no_docs, PATH, window=100, quantum=64)


def test_windows_hold_target_proportions(files):
    draw = random.Random(3)
    sizes = {"big": 400, "mid": 150, "few": 40, None: 60, "rare": 3}
    rows = [
        (i, " ".join(draw.choice(["river", "stone", "cloud"]) for _ in range(draw.choice([3, 40, 300]))), source)
        for i, source in enumerate(s for s, n in sizes.items() for _ in range(n))
    ]
    docs = files(rows, "doc_id long, text string, source string").repartition(5)
    found = mixture_packing.pack_mixture(docs, PATH, window=512, quantum=16).toPandas()
    total = found["length"].sum()
    tokens = found.assign(source=found["source"].fillna("null")).pivot_table(
        index="sequence_id", columns="source", values="length", aggfunc="sum", fill_value=0)
    full = tokens[tokens.sum(axis=1) == 512]
    assert len(full) == total // 512 > 50
    # The odd tokens of the sources come last; all windows before them keep the proportions.
    apart = (full.iloc[:-1] / 512 - tokens.sum() / total).abs()
    assert apart.max().max() <= 3 * 16 / 512
    # Over all windows so far nothing adds up.
    drift = (full.iloc[:-1].cumsum() - np.outer(np.arange(1, len(full)) * 512, tokens.sum() / total)).abs()
    assert drift.max().max() <= 3 * 16
    weighted = mixture_packing.pack_mixture(docs, PATH, {"few": 1, "mid": 1}, window=512, quantum=16).toPandas()
    start = weighted[weighted.sequence_id < 4].groupby("source")["length"].sum()
    assert abs(start["few"] - start["mid"]) <= 32 and set(start.index) == {"few", "mid"}


# Prefix refinement


def brute_divergence(rows, least=10, top=10):
    counts, docs, groups = Counter(), defaultdict(set), set()
    for at, (text, lang, source) in enumerate(rows):
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        for term in re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", lower(text)):
            counts[lang, source, term] += 1
            docs[lang, term].add(at)
    kept = defaultdict(list)
    for (lang, term), held in docs.items():
        if len(held) >= least:
            kept[lang].append(term)

    def shares(lang, sources):
        n = {t: sum(counts[lang, s, t] for s in sources) for t in kept[lang]}
        size = sum(n.values()) + 2 * len(n)
        return n, {t: 1 + 10**9 * (c + 2) // size for t, c in n.items()}

    out = set()
    for lang, source in groups:
        n, p = shares(lang, [source])
        pairs = []
        for other in (s for of, s in groups if of == lang and s != source):
            q = shares(lang, [other])[1]
            pairs.append((-sum((p[t] - q[t]) ** 2 // (p[t] + q[t]) for t in p), other.encode()))
        q = shares(lang, [s for of, s in groups if of == lang])[1]
        terms = [(-((p[t] - q[t]) ** 2 // (p[t] + q[t])), t.encode()) for t in p if n[t] and p[t] > q[t]]
        for part, ranked in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
            out |= {(lang, source, part, item.decode(), -v, i) for i, (v, item) in enumerate(ranked, 1)}
    return out


TEXTS = "text string, lang string, source string, term string, counts int"


def test_divergence_against_brute_force(files):
    draw = random.Random(11)
    stems = ["Haus", "haustür", "hausboot", "été", "日本語", "a", "b" * 70, "ab", "x" * 400, "straße"]
    rows = [
        (draw.choice([None, "", " ".join(draw.choice(stems) + draw.choice(["", "-", "7", "Q"]) for _ in range(12))])
         if draw.random() < 0.2 else "".join(draw.choice(stems[: 4 + i % 7]) + draw.choice(" .,_\n\x00") for _ in range(9)),
         draw.choice(["de", "fr", None]), draw.choice(["s1", "s2", "s3", None, ""]), "x", 1)
        for i in range(300)
    ] + [("rare words here", "it", "s1", "x", 1), ("", "it", "s2", "x", 1)] + [("twin " * 5, "en", "s", "x", 1)] * 10
    found = prefix_refinement.divergence(files(rows, TEXTS).repartition(4)).collect()
    assert {tuple(r) for r in found} == brute_divergence([r[:3] for r in rows])


def test_shares_divide_exactly(spark):
    draw = random.Random(1)
    rows = [(draw.randrange(10 ** draw.randint(1, 14)), draw.randrange(10**6)) for _ in range(500)]
    rows = [(c, c + draw.randrange(10 ** draw.randint(1, 15)), v + 1) for c, v in rows]
    df = spark.createDataFrame(rows, "c long, n long, v long")
    share = prefix_refinement._share(F.col("c"), F.col("n"), F.col("v"))
    got = [r[0] for r in df.select(share).collect()]
    assert got == [1 + 10**9 * (c + 2) // (n + 2 * v) for c, n, v in rows]


def test_divergence_of_odd_rows(docs, no_docs):
    rows = prefix_refinement.divergence(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {tuple(r) for r in rows} == brute_divergence([(r[1], None, r[2]) for r in ROWS])
    assert prefix_refinement.divergence(no_docs.withColumn("lang", F.lit("x"))).count() == 0


def test_longer_terms_are_split_alone():
    raw = "Ab abc-ABCD\nstra\u00dfe \u00e9\u00e9\u00a0x a1bcde\x7fzz \u4e2d\u6587".encode()
    for least in range(9):
        want = [term for term in prefix_refinement.terms_of(raw) if len(term) >= least]
        assert prefix_refinement.terms_from(least)(raw) == want


def test_batches_are_split_as_their_texts_are():
    draw = random.Random(4)
    pieces = ["Ab", "été", "日本語", " ", "\n", "\t\v\f\r", "\x00", "\x1c", "\x85", "\xa0", "-", "Z", "x" * 30, ""]
    texts = ["", " ", "A", *("".join(draw.choices(pieces, k=draw.randrange(9))) for _ in range(300)), "b", ""]
    whole = pa.array([text.encode() for text in texts], pa.binary())
    for fold, plain in ((prefix_refinement.TERM_BYTES, prefix_refinement.terms_of), (WORD_BYTES, words_of)):
        for least in (1, 2, 7):
            for column in (whole, whole.slice(3, 200), whole.slice(1, 1), whole[:0], pa.array([], pa.binary())):
                words, codes, starts = coded_words(column, fold, least)
                got = words.take(pa.array(codes)).to_pylist()
                want = [[w for w in plain(raw) if len(w) >= least] for raw in column.to_pylist()]
                assert [got[a:b] for a, b in zip(starts, starts[1:])] == want
                assert len(set(words.to_pylist())) == len(words)


def test_tally_adds_up_and_hands_on():
    draw = random.Random(5)
    tally = prefix_refinement.Tally("lang", "source", "term", "n")
    want, got, batches = Counter(), Counter(), 0
    for _ in range(40):
        rows = [(draw.choice([b"", b"de"]), draw.choice([b"s", b"t", b""])) for _ in range(9)]
        batch = pa.RecordBatch.from_arrays(
            [pa.array(column, pa.binary()) for column in zip(*rows)], names=["lang", "source"])
        group = tally.groups(batch)
        counts = Counter((int(g), bytes([draw.randrange(40)])) for g in group)
        names = dict(zip(group.tolist(), rows))
        want.update({(*names[g], term): n for (g, term), n in counts.items()})
        tally.add(np.array([g for g, _ in counts]), pa.array([t for _, t in counts]), np.array([*counts.values()]))
        for out in [*tally.rows(60)]:
            batches += 1
            got.update({tuple(row[:3]): row[3] for row in zip(*out.to_pydict().values())})
    assert batches < 30
    for out in tally.rows(0):
        got.update({tuple(row[:3]): row[3] for row in zip(*out.to_pydict().values())})
    assert got == want and not [*tally.rows(0)]


def test_refinement_is_exact_through_a_full_filter(files, monkeypatch):
    # A filter of eight bytes lets nearly everything through.
    monkeypatch.setattr(prefix_refinement, "MOST_BITS", 15)
    monkeypatch.setattr(prefix_refinement, "FEWEST_BITS", 15)
    rows = [(f"word{i:04d} common{i % 30:03d}", "en", "s") for i in range(3000)]
    raw = files(rows, "text string, lang string, source string").select(
        *[F.col(c).cast("binary").alias(n) for c, n in (("lang", "lang"), ("source", "source"), ("text", "raw"))])
    kept = prefix_refinement.kept_terms(raw)
    counts = {bytes(r.term).decode(): r.n for r in prefix_refinement.occurrences(raw, kept).collect()}
    assert counts == {"common": 3000, "word": 3000}
    full = [(f"{a}{b}{c}{d}stem", "en", "s") for a in "abcdefgh" for b in "abcdefgh" for c in "abcdefgh" for d in "abcd"]
    raw = files(full, "text string, lang string, source string").select(
        *[F.col(c).cast("binary").alias(n) for c, n in (("lang", "lang"), ("source", "source"), ("text", "raw"))])
    assert prefix_refinement.kept_terms(raw, least=2).count() == 0
    assert prefix_refinement.kept_terms(raw, least=1).count() == len(full)


# Phrase mining


def brute_phrases(rows, least, top=2000, longest=5):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        n[lang] += 0
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower(text)):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, longest + 1):
                for at in range(len(words) - size + 1):
                    f[lang][tuple(words[at : at + size])] += 1
    out = []
    for lang, counts in f.items():
        phrases = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        longer = Counter()
        for p, a in phrases.items():
            for size in range(2, len(p)):
                for at in range(len(p) - size + 1):
                    longer[p[at : at + size]] = max(longer[p[at : at + size]], a)
        rows = []
        for p, a in phrases.items():
            if 100 * longer[p] >= 100 * a:
                continue
            score, k = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return set(out)


SAID = "text string, lang string, phrase string, n int"


def said(seed, rows=250):
    draw = random.Random(seed)
    words = ["New", "York", "city", "hall", "of", "the", "é", "a-b", "日本", "x\x00y", "q\x1cr", "\x85"]
    odds = [9, 8, 6, 4, 9, 9, 2, 1, 1, 1, 1, 1]
    ends = [" "] * 12 + ["\t", "  ", ". ", ",", "\n", "\x0b", "? "]
    return [
        (None if i % 50 == 7 else "".join(w + draw.choice(ends) for w in draw.choices(words, odds, k=draw.choice([0, 4, 30]))),
         draw.choice(["en", "en", None, "", "fr"]), "x", 1)
        for i in range(rows)
    ]


@pytest.mark.parametrize("most, chunk", [(500_000, 1 << 20), (9, 64)])
def test_collocations_against_brute_force(files, monkeypatch, most, chunk):
    # Nine phrases a block and chunks of a few words: several passes, many borders.
    monkeypatch.setattr(phrase_trie, "CHUNK", chunk)
    rows = said(4) if most > 9 else said(5, 120)
    found = phrase_trie.collocations(files(rows, SAID).repartition(3), least=8, most=most, top=40)
    assert {tuple(r) for r in found.collect()} == brute_phrases([r[:2] for r in rows], 8, top=40)


def test_words_of_cut_texts(monkeypatch):
    monkeypatch.setattr(phrase_trie, "CHUNK", 16)
    text = b"Alpha beta, gamma\tdelta epsilon " * 3 + b"z" * 100 + b" end"
    whole = [t for run in phrase_trie.token_runs([text, b"", b"next."]) for t in run]
    monkeypatch.setattr(phrase_trie, "CHUNK", 1 << 20)
    assert whole == [t for run in phrase_trie.token_runs([text, b"", b"next."]) for t in run]


def test_collocations_of_odd_rows(docs, no_docs):
    rows = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {tuple(r) for r in phrase_trie.collocations(rows).collect()} == brute_phrases([(r[1], None) for r in ROWS], 100)
    assert phrase_trie.collocations(no_docs.withColumn("lang", F.lit("x"))).count() == 0


def test_double_array_finds_its_phrases_only():
    draw = random.Random(8)
    words = [f"w{i}".encode() for i in range(60)]
    phrases = sorted({tuple(draw.choices(words, k=3)) for _ in range(900)})
    trie = phrase_trie.DoubleArray(phrases)
    state = dict(zip(phrases, trie.states))
    assert len(set(trie.states)) == len(phrases)
    text = draw.choices(words + [b"other"], k=5000) + [w for p in phrases for w in p]
    states = trie.walk(np.array([trie.codes.get(w, 0) for w in text]))
    assert states.tolist() == [state.get(tuple(text[i : i + 3]), 0) for i in range(len(text))]


def test_phrases_leave_the_driver_and_are_one_pass_a_length(files, monkeypatch):
    # 40 words in random order: some 40,000 threes, in five blocks.
    draw = random.Random(11)
    rows = [(" ".join(draw.choices([f"w{i}" for i in range(40)], k=40)), "en", "x", 1) for _ in range(1700)]
    raw = files(rows, SAID).select(F.col("lang").cast("binary").alias("lang"), F.col("text").cast("binary").alias("raw"))
    passes, longer = [], phrase_trie._longer
    monkeypatch.setattr(phrase_trie, "_longer", lambda *given: passes.append(1) or longer(*given))
    tracemalloc.start()
    try:
        found = phrase_trie.frequent_phrases(raw, longest=4, least=1, most=10_000)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    counts = Counter(tuple(t[at : at + k]) for t in (r[0].split() for r in rows) for k in (1, 2, 3, 4) for at in range(len(t) - k + 1))
    by_length = Counter(map(len, counts))
    assert by_length[3] > 30_000
    phrases = found.where("phrase is not null")
    assert {r["words"]: r["count"] for r in phrases.groupBy("words").count().collect()} == by_length
    some = phrases.where("words > 2 and crc32(phrase) % 50 = 0").collect()
    assert len(some) > 1000 and all(counts[tuple(bytes(r["phrase"]).decode().split())] == r["n"] for r in some)
    assert len(passes) == 3
    # Ten thousand phrases at a time, as arrays.
    assert most < 6 << 20


def test_double_array_of_many_words():
    # Some states have a thousand words after them, most have one.
    draw = np.random.default_rng(3)
    rows = np.unique(np.minimum(draw.zipf(1.2, (30_000, 4)), 50_000).astype(np.int32), axis=0)
    trie = phrase_trie.DoubleArray(rows, 50_000)
    assert len(np.unique(trie.states)) == len(rows) and len(trie.base) < 20 * len(rows)
    text = np.concatenate([rows.ravel(), np.minimum(draw.zipf(1.2, 50_000), 50_001) % 50_001]).astype(np.int32)
    state = {tuple(row): at for row, at in zip(rows.tolist(), trie.states.tolist())}
    windows = np.lib.stride_tricks.sliding_window_view(np.r_[text, np.zeros(3, np.int32)], 4).tolist()
    assert trie.walk(text).tolist() == [state.get(tuple(window), 0) for window in windows]


def test_numbered_runs_hold_long_texts(files, monkeypatch):
    # Texts of several runs, in blocks of a few words; rarer words and cuts end a phrase.
    words = ["aa", "bb", "cc", "dd"]
    draw = random.Random(2)
    rows = [(" ".join(draw.choices(words + ["rare%d" % i, "ee.", "ee,"], [9, 9, 9, 9, 1, 2, 2], k=9000)), lang, "x", 1)
            for i, lang in enumerate(["en", None, "en", "fr"])]
    found = phrase_trie.collocations(files(rows, SAID), least=40, most=3, top=50)
    assert {tuple(r) for r in found.collect()} == brute_phrases([r[:2] for r in rows], 40, top=50)
