from __future__ import annotations

import hashlib
import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from corpus_cases import frame, no_documents, odd_documents, odd_texts, prose
from pyspark.sql import functions as F
from tidemark.llm import (
    decontamination,
    htmltext,
    langid,
    licenses,
    licensetexts,
    linking,
    mixing,
    neardup,
    paragraphs,
    suffixes,
    tokencounts,
    topk,
)
from tidemark.llm.scratch import Scratch
from tidemark.llm.textarrays import ALNUM, LOWER, byte_chunks, sequence_hashes, words

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


# op4


def shingles(text: str | None) -> set:
    w = SPACE_WORD.findall(lower(text))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_components(sets: dict[int, set]) -> dict[int, int]:
    root = {i: i for i in sets}
    changed = True
    links = [
        (a, b)
        for a, b in combinations(sorted(sets), 2)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    while changed:
        changed = False
        for a, b in links:
            least = min(root[a], root[b])
            if root[a] != least or root[b] != least:
                root[a] = root[b] = least
                changed = True
    return root


def test_near_duplicates_match_brute_force(spark):
    rng = np.random.default_rng(3)
    texts = odd_texts()
    # A large group of variants: some close enough to be linked, some not; and chains of changes.
    words = prose(40, 120).split()
    for i in range(60):
        mutated = list(words)
        for at in rng.integers(0, len(words), int(rng.integers(0, 12))):
            mutated[at] = f"w{i}x{at}"
        texts.append(" ".join(mutated))
    chain = prose(50, 200).split()
    for i in range(8):
        chain = chain[:]
        chain[10 + 20 * i] = f"link{i}"
        texts.append(" ".join(chain))
    got = {r[0]: r for r in neardup.near_duplicates(frame(spark, [(i, t, "s") for i, t in enumerate(texts)])).collect()}
    sets = {i: shingles(t) for i, t in enumerate(texts)}
    root = brute_components(sets)
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == {
        i: (len(sets[i]), root[i], root[i] == i) for i in sets
    }


def test_unlike_variants_of_one_text_are_not_compared_with_each_other(spark):
    rng = np.random.default_rng(12)
    base = rng.integers(0, 1 << 62, 150)
    sets = {}
    for i in range(400):
        own = base.copy()
        for at in rng.integers(0, 146, int(rng.integers(0, 10))):
            own[at : at + 5] = rng.integers(0, 1 << 62, 5)
        sets[i] = np.unique(own)
    df = spark.createDataFrame([(i, bytearray(x.tobytes())) for i, x in sets.items()], "node long, members binary")
    similar, compared = set(), set()
    for i, j in combinations(sets, 2):
        common = len(np.intersect1d(sets[i], sets[j]))
        if 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
            similar.add((i, j))

    def confirm(pairs):
        got = {(r.a, r.b) for r in pairs.collect()}
        compared.update(got)
        return spark.createDataFrame(sorted(got & similar), "a long, b long")

    with Scratch(spark) as scratch:
        members = scratch.put(df.select(F.lit(1).cast("long").alias("key"), "node"), "test-members")
        roots = linking.link_by_keys(members, confirm, scratch, "test", lambda n: neardup.finer_keys(df.join(n, "node"), scratch))
        got = {r.node: r.root for r in roots.collect()}
    want = {i: i for i in sets}
    for i, j in sorted(similar):
        low, high = sorted((want[i], want[j]))
        want = {k: low if r == high else r for k, r in want.items()}
    assert {i: got.get(i, i) for i in sets} == want
    # 79,800 pairs in all; the first round compares 399.
    assert len(similar) > 10_000 and len(compared) < 4_000


def test_near_duplicates_of_nothing_and_repeated_rows(spark):
    assert neardup.near_duplicates(no_documents(spark)).collect() == []
    rows = neardup.near_duplicates(frame(spark, [(5, prose(1, 50), "s"), (5, prose(1, 50), "s"), (None, "a b", "s")])).collect()
    assert sorted((r.doc_id or -1, r.n_shingles) for r in rows) == [(-1, 1), (5, 46), (5, 46)]


def test_keep_representatives_keeps_columns(spark):
    docs = odd_documents(spark)
    kept = neardup.keep_representatives(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [i for i in range(17) if i not in (1, 2, 11)]


def test_components_of_long_chains(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001)], "a long, b long")
    with Scratch(spark) as scratch:
        got = {r.node: r.root for r in linking.components(links, scratch).collect()}
    assert got == {**{i: 0 for i in range(301)}, 1000: 1000, 1001: 1000}


# op1


def test_embedded_passage_is_cut_once_and_clean_text_stays(spark):
    texts = odd_texts()
    docs = odd_documents(spark)
    got = {r.doc_id: r for r in paragraphs.repeat_report(docs).collect()}
    assert len(got) == len(texts)
    assert got[1].text.strip() == "" and got[1].n_removed > 0 and got[1].first_docs == [0]
    assert got[4].n_removed == 0 and got[5].n_removed > 100 and got[5].first_docs == [4]
    for i in (0, 3, 4, 6, 7, 8, 9, 10, 14, 15, 16):
        assert got[i].text == texts[i] and got[i].n_spans == 0
    assert all(r.n_bytes == len((texts[i] or "").encode()) for i, r in got.items())
    kept = paragraphs.remove_repeats(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [i for i in range(17) if i != 1]
    assert paragraphs.repeat_report(no_documents(spark)).collect() == []


def test_near_paragraphs_are_linked(spark):
    line = " ".join(f"word{i}" for i in range(18))
    changed = line + " more"
    texts = [prose(20, 50) + "\n" + line + "\n" + prose(21, 50), prose(22, 50) + "\n" + changed + "\n" + prose(23, 50)]
    got = {r.doc_id: r for r in paragraphs.repeat_report(frame(spark, [(i, t, "s") for i, t in enumerate(texts)])).collect()}
    assert got[0].text == texts[0]
    assert got[1].text == texts[1].replace(changed + "\n", "")


def test_long_line_with_one_changed_word_leaves_that_word(spark):
    rng = random.Random(5)
    line = [f"word{rng.randrange(10**6)}" for _ in range(60)]
    changed = [*line[:30], "other", *line[31:]]
    texts = [prose(20, 50) + "\n" + " ".join(line) + "\n" + prose(21, 50), prose(22, 50) + "\n" + " ".join(changed) + "\n" + prose(23, 50)]
    got = {r.doc_id: r for r in paragraphs.repeat_report(frame(spark, [(i, t, "s") for i, t in enumerate(texts)])).collect()}
    assert got[0].text == texts[0]
    assert got[1].text == texts[1].replace(" ".join(changed), "other ")


def test_embedded_passages_match_brute_force(spark):
    rng = random.Random(6)

    def some(n: int) -> list[str]:
        return [f"w{rng.randrange(10**7)}" for _ in range(n)]

    texts = []
    for n in [14, 20, 30, *range(51, 101, 3)]:
        passage = some(n)
        for copy in range(2):
            before, after = some(rng.randrange(5, 60)), some(rng.randrange(5, 60))
            inner = list(passage)
            if copy and n % 2:
                # Line breaks elsewhere do not matter.
                inner[n // 2] += "\n" + inner.pop(n // 2 + 1)
            texts.append(" ".join([*before, *inner, *after]))
    texts.append("again " * 40)
    got = {r.doc_id: r.text for r in paragraphs.repeat_report(frame(spark, [(i, t, "s") for i, t in enumerate(texts)])).collect()}
    seen: dict[tuple, tuple] = {}
    for i, text in enumerate(texts):
        w = SPACE_WORD.findall(text)
        covered = set()
        for at in range(len(w) - 13):
            d, p = seen.setdefault(tuple(w[at : at + 14]), (i, at))
            if d != i or at >= p + 14:
                covered |= set(range(at, at + 14))
        kept = set(SPACE_WORD.findall(got[i]))
        gone = [x for j, x in enumerate(w) if j in covered and x != "again"]
        assert not kept & set(gone)
        # A piece at either end of a passage may be similar with a word or more that differ.
        assert len(w) - len(covered) - len(SPACE_WORD.findall(got[i])) <= 6


def packed_sets(spark, sizes: range, per_size: int, seed: int):
    """Sets in pairs (2 i, 2 i + 1) at a similarity of 0.75 or little more."""
    rng = np.random.default_rng(seed)
    sets = []
    for n in sizes:
        for _ in range(per_size):
            own = rng.integers(0, 2**32, n, dtype=np.uint32)
            swapped = n // 7
            other = np.concatenate([own[swapped:], rng.integers(0, 2**32, swapped, dtype=np.uint32)])
            sets += [np.unique(own), np.unique(other)]
    return sets, spark.createDataFrame([(i, bytearray(x.tobytes())) for i, x in enumerate(sets)], "unit long, shingles binary")


def test_similar_sets_of_all_sizes_share_keys(spark):
    sets, df = packed_sets(spark, range(1, 90), 20, 9)
    for found, name in ((paragraphs.set_keys(df), "unit"), (paragraphs.finer_keys(df), "node")):
        keys: dict[int, set] = {}
        for r in found.collect():
            keys.setdefault(r[name], set()).add(r.key)
        for i in range(0, len(sets), 2):
            assert keys[i] & keys[i + 1], len(sets[i])


def test_shingles_that_many_share_are_keys_of_few(spark):
    rng = np.random.default_rng(10)
    often = rng.integers(0, 2**31, 6, dtype=np.uint32)  # the lower half, so among the first by value
    sets = []
    for _ in range(400):
        own = rng.integers(0, 2**32, 18, dtype=np.uint32)
        other = np.concatenate([own[2:], rng.integers(0, 2**32, 2, dtype=np.uint32)])
        sets += [np.unique(np.concatenate([often, x])) for x in (own, other)]
    df = spark.createDataFrame([(i, bytearray(x.tobytes())) for i, x in enumerate(sets)], "unit long, shingles binary")
    found = paragraphs.set_keys(df, paragraphs.common_shingles(df)).collect()
    keys: dict[int, set] = {}
    for r in found:
        keys.setdefault(r.unit, set()).add(r.key)
    assert all(keys[i] & keys[i + 1] for i in range(0, len(sets), 2))
    assert max(Counter(r.key for r in found).values()) <= 4


def test_finer_keys_meet_for_all_similar_small_sets(spark):
    rng = np.random.default_rng(8)
    base = rng.integers(0, 2**32, 14, dtype=np.uint32)
    sets = []
    for n in range(1, 15):
        for _ in range(6):
            own = np.concatenate([rng.permutation(base)[:n], rng.integers(0, 2**32, int(rng.integers(0, 3)), dtype=np.uint32)])
            sets.append(np.unique(own))
    df = spark.createDataFrame([(i, bytearray(x.tobytes())) for i, x in enumerate(sets)], "unit long, shingles binary")
    keys: dict[int, set] = {}
    for r in paragraphs.finer_keys(df).collect():
        keys.setdefault(r.node, set()).add(r.key)
    for i, j in combinations(range(len(sets)), 2):
        common = len(np.intersect1d(sets[i], sets[j]))
        union = len(sets[i]) + len(sets[j]) - common
        if 100 * common >= 75 * union and union <= 11:
            assert keys[i] & keys[j]


def test_finer_keys_are_no_more_than_first_ones(spark):
    sets, df = packed_sets(spark, range(1, 48), 4, 12)
    found = Counter(r.node for r in paragraphs.finer_keys(df).collect())
    for i, x in enumerate(sets):
        assert found[i] <= len(x) - -(-len(x) * 75 // 100) + 1


def test_variants_of_one_paragraph_meet_its_middle_first(spark):
    rng = np.random.default_rng(14)
    base = rng.integers(0, 2**32, 40, dtype=np.uint32)
    sets = [base]
    for at in rng.integers(0, 36, 60).tolist():
        sets.append(np.concatenate([base[:at], rng.integers(0, 2**32, 5, dtype=np.uint32), base[at + 5 :]]))
    # The middle has the largest id.
    sets = [np.unique(x) for x in reversed(sets)]
    df = spark.createDataFrame([(i, bytearray(x.tobytes())) for i, x in enumerate(sets)], "unit long, shingles binary")
    compared = []

    def similar(a: int, b: int) -> bool:
        common = len(np.intersect1d(sets[a], sets[b]))
        return 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common)

    def confirm(pairs):
        compared.extend(own := [(r.a, r.b) for r in pairs.collect()])
        return spark.createDataFrame([x for x in own if similar(*x)], "a long, b long")

    with Scratch(spark) as scratch:
        keys = paragraphs.set_keys(df, paragraphs.common_shingles(df)).withColumnRenamed("unit", "node")
        members = scratch.put(keys, "test-members")
        roots = {r.node: r.root for r in linking.link_by_keys(members, confirm, scratch, "test", None).collect()}
    assert set(roots.values()) == {0} and len(roots) == 61
    assert len(compared) < 300


def test_runs_are_the_same_in_batches_of_any_size():
    rng = random.Random(15)
    spans = sorted((ord_ << 30 | rng.randrange(60), rng.choice([3, 7, 14]), rng.randrange(4) << 30) for ord_ in range(6) for _ in range(9))

    def runs(size: int) -> list[tuple]:
        parts = [list(zip(*spans[i : i + size], strict=True)) for i in range(0, len(spans), size)]
        batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in p], ["pos", "n_words", "first"]) for p in parts]
        return sorted(tuple(r.values()) for b in paragraphs._runs(iter(batches)) for r in b.to_pylist())

    want = set()
    for ord_ in range(6):
        own = [(p & 0xFFFF, n, f >> 30) for p, n, f in spans if p >> 30 == ord_]
        covered = {w for p, n, _ in own for w in range(p, p + n)}
        for p, _, _ in own:
            lo = hi = p
            while lo - 1 in covered:
                lo -= 1
            while hi in covered:
                hi += 1
            inside = [x for x in own if lo <= x[0] < hi]
            want |= {(ord_, lo, hi - lo, max(x[1] for x in inside), x[2]) for x in inside}
    assert runs(1) == runs(7) == runs(100) == sorted(want)


def test_repeated_windows_travel_as_rows_of_blocks(spark):
    rng = random.Random(16)
    common = [f"c{i}" for i in range(30)]
    texts = [[*(f"w{rng.randrange(10**7)}" for _ in range(rng.randrange(5, 60))), *common[rng.randrange(9) :]] * (1 + i % 2) for i in range(40)]
    buckets = 3
    with Scratch(spark) as scratch:
        rows = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)] + [(40, None)], "ord long, text string")
        held = scratch.put(paragraphs.blocks(rows.repartition(4)), "test-blocks")
        found = paragraphs.repeated_seeds(held, buckets)
        n_blocks = held.count()
        assert n_blocks <= 4 and found.count() <= buckets * n_blocks
        listed = found.groupBy("block").agg(F.collect_list("seeds").alias("seeds"))
        dealt = scratch.put(paragraphs.windows(held.join(listed, "block"), buckets), "test-dealt")
        assert dealt.count() <= (buckets + 1) * n_blocks
        met = paragraphs.met(dealt).collect()
    first_of: dict[int, int] = {}
    later: list[tuple[int, int]] = []
    for r in met:
        lo, first, pos, later_lo = (np.frombuffer(x or b"", np.int64).tolist() for x in (r.lo, r.first, r.pos, r.later_lo))
        first_of.update(zip(lo, first, strict=True))
        later += zip(pos, later_lo, strict=True)
    got = {*first_of.items(), *((p, first_of[x]) for p, x in later)}
    seen: dict[tuple, list[int]] = {}
    for i, t in enumerate(texts):
        for at in range(len(t) - 13):
            seen.setdefault(tuple(t[at : at + 14]), []).append(i << 30 | at)
    assert got == {(p, places[0]) for places in seen.values() if len(places) > 1 for p in places}


def test_order_of_shingles_is_by_count_then_value():
    rng = np.random.default_rng(17)
    sets = [np.unique(rng.integers(0, 60, k, dtype=np.uint32)) for k in (1, 5, 20, 40)]
    common = np.arange(0, 60, 3, dtype=np.uint32), rng.integers(2, 6, 20)
    often = dict(zip(*(x.tolist() for x in common), strict=True))
    got = paragraphs._rarest_first(np.concatenate(sets), np.array([len(x) for x in sets]), common)
    assert got.tolist() == [v for x in sets for v in sorted(x.tolist(), key=lambda v: (often.get(v, 0), v))]


def test_shuffle_files_go_with_the_table(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
    before = files.getAllFiles().size()
    with Scratch(spark) as scratch:
        out = scratch.put(spark.range(1000).groupBy((F.col("id") % 100).alias("k")).count(), "test-freed")
        assert files.getAllFiles().size() <= before
        assert out.count() == 100


# op6


def brute_suffix(texts: list[str | None], width: int = 200) -> list[tuple]:
    raws = [(t or "").encode() for t in texts]
    count = Counter(r[i : i + width] for r in raws for i in range(len(r) - width + 1))
    out = []
    for r in raws:
        covered = np.zeros(len(r), bool)
        for i in range(len(r) - width + 1):
            if count[r[i : i + width]] > 1:
                covered[i : i + width] = True
        kept = bytes(b for b, c in zip(r, covered, strict=True) if not c)
        runs = int((np.diff(covered.astype(int), prepend=0) == 1).sum())
        out.append((len(r), int(covered.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def test_repeated_bytes_match_brute_force(spark):
    long = prose(14, 2_000)
    texts = [t if t is None or len(t) < 5_000 else long for t in odd_texts()]
    a, b = prose(30, 100), prose(31, 100)
    # Repeats of just under, at and just over the width, overlapping and within one text.
    texts += [a[:199] + "!" + b[:200], "?" + b[:200] + a[:199], b[1:201] + "é" + b[1:202], "ab" * 150, long[100:700] + long[400:900]]
    got = {r[0]: tuple(r)[1:] for r in suffixes.remove_repeated(frame(spark, [(i, t, "s") for i, t in enumerate(texts)])).collect()}
    assert got == dict(enumerate(brute_suffix(texts)))


def test_repeated_rows_repeat_each_other(spark):
    text = prose(33, 100)
    got = suffixes.remove_repeated(frame(spark, [(1, text, "s"), (1, text, "s"), (None, text[:300], "s")])).collect()
    assert sorted((r.doc_id or 0, r.n_bytes - r.n_removed) for r in got) == [(0, 0), (1, 0), (1, 0)]
    assert suffixes.remove_repeated(no_documents(spark)).collect() == []


def test_loser_tree_merges_like_sorted():
    rng = np.random.default_rng(2)
    for runs in (0, 1, 2, 5, 9):
        parts = [sorted(bytes(rng.integers(97, 99, int(n)).astype(np.uint8)) for n in rng.integers(0, 9, 20)) for _ in range(runs)]
        coded = [(p, [0] + [suffixes.common_prefix(x, y, 0) for x, y in zip(p, p[1:], strict=False)]) for p in parts]
        merged = list(suffixes.LoserTree(coded))
        strings = [parts[r][i] for r, i, _ in merged]
        assert strings == sorted(s for p in parts for s in p)
        assert [n for _, _, n in merged[1:]] == [suffixes.common_prefix(x, y, 0) for x, y in zip(strings, strings[1:], strict=False)]


# op9


def brute_windows(text: str | None, n: int = 10) -> tuple[list, list]:
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    return w, [tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))] if w else []


def test_windows_match_brute_force_in_one_and_many_blocks(spark):
    texts = odd_texts()
    items = [(1, texts[3][:400]), (20, texts[3][300:700]), (3, "one two three"), (4, None), (5, "..."), (None, texts[14][5000:5300]), (1, texts[3][:400])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = odd_documents(spark)
    for blocks in (None, 7):
        found = decontamination.find_windows(docs.select("doc_id", "text"), bench, block_windows=blocks or 10**6)
        got = {r.doc_id: (r[decontamination.HITS], r[decontamination.ITEMS], r[decontamination.N_WORDS]) for r in found.collect()}
        for i, text in enumerate(texts):
            w, _ = brute_windows(text)
            hits, ids = set(), set()
            for item, t in items:
                for x in brute_windows(t)[1]:
                    for at in range(len(w) - len(x) + 1):
                        if tuple(w[at : at + len(x)]) == x:
                            hits |= set(range(at, at + len(x)))
                            ids |= {item} - {None}
            assert got[i] == (sorted(hits), sorted(ids), len(w))
    report = {r.doc_id: r for r in decontamination.decontaminate(docs, bench).collect()}
    assert report[3].items_sha256 == hashlib.sha256(b"1,20").hexdigest() and report[3].n_items == 2
    assert report[14].contaminated and report[14].n_items == 0
    assert decontamination.drop_contaminated(docs, bench).columns == docs.columns
    assert decontamination.decontaminate(docs, bench.limit(0)).where("contaminated").count() == 0
    assert decontamination.decontaminate(no_documents(spark), bench).count() == 0


# op3


def test_token_counts_equal_the_library(spark):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public.path("byte_bpe_50k.json")
    texts = odd_texts()
    docs = odd_documents(spark)
    tok = Tokenizer.from_file(path)
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in tokencounts.token_counts(docs, path, public.PATTERN).collect()}
    want = [len(e) for e in tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert got == {i: (len((t or "").encode()), n, n > 512) for i, (t, n) in enumerate(zip(texts, want, strict=True))}
    twice = docs.union(docs)
    assert tokencounts.token_counts(twice, path, public.PATTERN).count() == 2 * len(texts)
    assert tokencounts.token_counts(no_documents(spark), path, public.PATTERN).count() == 0


# op2


def test_top_products_match_brute_force(spark):
    rng = np.random.default_rng(1)
    vectors = [(i, [float(x) for x in rng.normal(0, 0.3, 6)]) for i in range(300)]
    vectors += [(i, [0.5, 0.25, 0.0, 0.0, -1.0, 0.125]) for i in range(300, 360)]
    vectors += [(400, [0.0] * 6), (450, None), (500, [None] * 6), (550, [float("nan")] * 6), (600, [float("inf")] * 6), (650, [0.1]), (None, [1.0] * 6)]
    vectors.append(vectors[3])
    df = topk.whole_vectors(spark.createDataFrame(vectors, "vec_id long, embedding array<float>"))
    got = topk.top_products(df, df.where("vec_id % 50 = 0")).collect()
    valid = {i: np.array([*np.floor(256 * np.array(v, np.float32).astype(float)), *[0] * (6 - len(v))], int) for i, v in vectors if i is not None and i not in (450, 500, 550, 600)}
    want = []
    for q in sorted(i for i in valid if i % 50 == 0):
        best = sorted(((-int(valid[q] @ v), i) for i, v in valid.items() if i != q))[:5]
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    assert sorted(map(tuple, got)) == want
    empty = topk.whole_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>"))
    assert topk.top_products(empty, empty).collect() == []


def test_threshold_search_stops_early_with_the_right_result():
    rng = np.random.default_rng(4)
    vectors = rng.integers(-100, 100, (3000, 4))
    ids = rng.permutation(3000)
    rows, found, scores = topk.threshold_search(ids, vectors, ids[:20], vectors[:20], 5)
    for r in range(20):
        best = sorted((-int(vectors[r] @ vectors[j]), int(ids[j])) for j in range(3000) if j != r)[:5]
        assert [(-s, i) for q, i, s in zip(rows, found, scores, strict=True) if q == r] == best


# op5


def test_language_model_learns_from_its_fold_only(spark):
    words = {"aa": "kato mila suren pako".split(), "bb": "zgrum fjord vrast plink".split()}
    rng = np.random.default_rng(6)
    rows = []
    for i in range(400):
        lang = ("aa", "bb")[i % 2]
        rows.append((i, " ".join(rng.choice(words[lang], 12)), lang))
    rows += [(1000, None, "aa"), (1001, "123 456 !", "bb"), (1002, "", "aa"), (1003, "zgrum vrast plink", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in langid.identify(docs).collect()}
    assert len(got) == len(rows)
    assert all(got[i].lang_pred == ("aa", "bb")[i % 2] and 0.5 <= got[i].score <= 1 for i in range(400))
    assert {got[i].lang_pred for i in (1000, 1001, 1002)} == {"und"} and got[1003].lang_pred == "bb"
    from zlib import crc32

    assert all(got[i].held_out == (crc32(str(i).encode()) % 4 == 2) for i in range(400))
    kept = langid.keep_identified(docs)
    assert kept.columns == docs.columns and kept.count() == 401
    none = langid.identify(docs.limit(0))
    assert none.collect() == [] and {r.lang_pred for r in langid.identify(docs.selectExpr("doc_id", "text", "cast(null as string) lang")).collect()} == {"und"}


def test_ngrams_do_not_cross_texts():
    together, offsets = langid.char_features(["ab", "", "c", "abc"])
    for text, lo, hi in zip(["ab", "", "c", "abc"], offsets[:-1], offsets[1:], strict=True):
        alone, _ = langid.char_features([text])
        assert [p[lo:hi].tolist() for p in together] == [p.tolist() for p in alone]


# op7


def test_mix_comes_near_its_targets(spark):
    rows = [(i, prose(i, 20 + i % 90), ["a", "b", None, "c"][(i * i) % 4 if i % 3 else 0]) for i in range(300)]
    rows += [(900, None, "a"), (901, "", "empty"), (902, "one", "tiny"), (5, prose(5, 25), "a")]
    docs = frame(spark, rows)
    got = mixing.mix_to_targets(docs).collect()
    assert len(got) == len(rows)
    size = lambda t: len(SPACE_WORD.findall(t or ""))
    assert sum(r["size"] for r in got) == sum(size(t) for _, t, _ in rows)
    targets = {r.source: r.target for r in got}
    assert abs(sum(targets.values()) - sum(r["size"] for r in got)) < 1e-6
    for source, target in targets.items():
        taken = sum(r.taken for r in got if r.source == source)
        assert abs(taken - target) <= 64 + 1 and target <= 3 * next(r.source_size for r in got if r.source == source)
    assert all(0 <= r.taken <= 3 * r["size"] for r in got)
    again = mixing.mix_to_targets(docs.repartition(5)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    assert mixing.mix_to_targets(no_documents(spark)).collect() == []
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == [*docs.columns, "mix_size", "mix_target", "mix_taken"]


def test_mix_order_is_by_finish_time(spark):
    docs = frame(spark, [(i, prose(i, 30), "ab"[i % 2]) for i in range(60)])
    with Scratch(spark) as scratch:
        sized = scratch.put(mixing.sizes(docs), "sizes")
        targets = scratch.put(mixing.source_targets(sized), "targets")
        mix = mixing.fair_mix(sized, targets).collect()
    assert [r.finish for r in mix] == sorted(r.finish for r in mix)
    assert mix[-1].served >= 60 * 30 and sum(r.taken for r in mix) == 60 * 30


# op8

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
<header>Site</header><nav><ul><li><a href=/a>A</a></ul></nav><div class="cookie-notice">We use cookies, really, many of them.</div>
<div id="main-content"><article><h1>Title &amp; more</h1><p>First paragraph, with <b>bo</b>ld&nbsp;text, and commas, enough for points.
<p>Second   paragraph<br>goes on, and on, with words &lt;kept&gt;.</p><ul><li>item one</li><li>item two</ul><script>x</script>
<div class="ad">Buy this, buy that, buy more things now, please.</div></article>
<section class="comments"><p>Reader says, this is a long comment, with commas, many, many.</p></section></div>
<aside>Related, things, to read, elsewhere, now.</aside><form>Sign up, now, please, do it.</form><footer>&copy; x</footer><!-- c --></body></html>"""
WANT = "Title & more First paragraph, with bold text, and commas, enough for points. Second paragraph goes on, and on, with words <kept>. item one item two"


def test_main_text(spark):
    assert htmltext.main_text(PAGE) == WANT
    assert htmltext.main_text(PAGE[: PAGE.index("<section")]) == WANT
    pages = spark.createDataFrame(
        [(1, "u", PAGE, "x"), (2, None, None, "x"), (3, "u", "", "x"), (4, "u", "<p>short</p><p", "x"), (5, "u", "plain & text", "x"), (5, "u", "plain & text", "x")],
        "page_id long, url string, html string, text string",
    )
    got = sorted(map(tuple, htmltext.extract(pages).select("page_id", "text", "n_chars").collect()))
    assert got == [(1, WANT, len(WANT)), (2, "", 0), (3, "", 0), (4, "short", 5), (5, "plain & text", 12), (5, "plain & text", 12)]
    assert htmltext.extract(pages.limit(0)).count() == 0


@pytest.mark.parametrize(
    ("wording", "name"),
    [
        ("SPDX-License-Identifier: MIT", "MIT"),
        ("SPDX-License-Identifier: GPL-2.0-or-later", "GPL-2.0"),
        ("licensed under the terms of the MIT license", "MIT"),
        *((text, name) for name, text in [*licensetexts.whole_texts(), *licensetexts.MORE_TEXTS]),
    ],
)
def test_licence_texts_and_tags_are_found(wording, name):
    scanner = licenses.Scanner(licensetexts.templates())
    ((_, data, offsets),) = byte_chunks(pa.array([f"{prose(70, 50)} {wording} {prose(71, 900)}"]))
    w = words(LOWER[data], offsets, ALNUM, lower=False)
    found = scanner.row_matches(sequence_hashes(w.hashes, 2))
    assert name in {scanner.names[t] for _, t, _, _ in found}
    assert max(n for _, _, _, n in found) >= 0.9 * len(licenses._word_hashes(wording))


@pytest.mark.parametrize(
    ("wording", "names"),
    [
        ("This work is licensed under the Mozilla Public License, version 1.1.", {"MPL-1.1"}),
        ("This software is licensed under the Eclipse Public License, version 1.0.", {"EPL-1.0"}),
        ("This work is licensed under CC BY-NC-SA 2.0", {"CC-BY-NC-SA-2.0"}),
        ("This work is licensed under CC BY-NC-SA 1.0", set()),
        ("Licensed under the GNU General Public License, version 1", {"GPL-1.0"}),
        ("Licensed under the GNU General Public License, version 2.0", {"GPL-2.0"}),
        ("Licensed under the GNU Lesser General Public License, version 2", {"LGPL-2.0"}),
        ("Licensed under the GNU Lesser General Public License, version 2.1", {"LGPL-2.1"}),
        ("Licensed under the GNU Lesser General Public License, version 2.7", set()),
        ("This work is licensed under the Common Public License, version 1.0.", set()),
        ("MIT License", {"MIT"}),
        ("Licensed under MIT", {"MIT"}),
        ("This project is licensed under MIT license", {"MIT"}),
        ("This project is licensed under the very nice conditions of nobody", set()),
    ],
)
def test_notices_are_told_apart_by_name_and_version(wording, names):
    scanner = licenses.Scanner(licensetexts.templates())
    ((_, data, offsets),) = byte_chunks(pa.array([f"{prose(72, 50)} {wording} {prose(73, 60)}"]))
    w = words(LOWER[data], offsets, ALNUM, lower=False)
    assert {scanner.names[t] for _, t, _, _ in scanner.row_matches(sequence_hashes(w.hashes, 2))} == names


def test_many_notices_in_one_text_take_time_by_its_length():
    import time

    scanner = licenses.Scanner(licensetexts.templates())

    def seconds(n: int) -> float:
        ((_, data, offsets),) = byte_chunks(pa.array(["Licensed under the MIT License and more words. " * n]))
        w = words(LOWER[data], offsets, ALNUM, lower=False)
        began = time.process_time()
        assert len(scanner.row_matches(sequence_hashes(w.hashes, 2))) == n
        return time.process_time() - began

    seconds(100)
    assert seconds(8_000) < 12 * seconds(2_000) + 0.5


def test_layout_names_do_not_hide_the_article():
    first, second = prose(60, 80).replace("\n", " "), prose(61, 80).replace("\n", " ")
    text = f"<p>{first}</p><p>{second}</p>"
    junk = "<div class='sidebar'><p>Short words, of a side column, that nobody wants.</p></div>"
    want = " ".join(f"{first} {second}".split())
    for opening in (
        "<div class='content has-sidebar'>",
        "<div class='no-sidebar'>",
        "<div id='page' class='has-header-image'>",
        "<section class='social-studies'>",
        "<div class='page sidebar-left'>",
    ):
        closing = f"</{opening[1:].split()[0]}>"
        for inner in (text, f"<article>{text}</article>", f"<main>{text}</main>"):
            assert htmltext.main_text(f"<html><body>{opening}{inner}{junk}{closing}</body></html>") == want
    # What is junk stays junk: side columns and comments, even if these are longer than the article.
    for name in ("comments", "comment-list"):
        page = f"<div class='post'>{text}</div>{junk}<div class='{name}'><article class='comment'>{text * 3}</article></div>"
        assert htmltext.main_text(f"<html><body>{page}</body></html>") == want


def test_names_and_forms_around_articles_do_not_hide_them():
    first, second = prose(62, 80).replace("\n", " "), prose(63, 80).replace("\n", " ")
    tidy = lambda *t: " ".join(" ".join(t).split())
    text = f"<p>{first}</p><p>{second}</p>"
    for page in (
        f"<form id='aspnetForm' action='/'><div>{text}</div></form>",
        f"<form><main>{text}</main><div class='search-form'>Search, here, for, more, things</div></form>",
        f"<article><p>{first}</p><p class='share-price'>{second}</p></article>",
        f"<article><p>{first}</p><section id='search-results-analysis'><p>{second}</p></section></article>",
        f"<article><p>{first}</p><div class='rail-network'><p>{second}</p></div></article>",
    ):
        assert htmltext.main_text(f"<html><body>{page}</body></html>") == tidy(first, second)
    # A short last section, in an article or beside its other sections, belongs to the text.
    sections = f"<section><h2>One</h2><p>{first}</p></section><section><h2>Two</h2><p>{second}</p></section>"
    short = "<section><h2>Three</h2><p>The end, so far.</p></section>"
    want = tidy("One", first, "Two", second, "Three The end, so far.")
    for opening in ("<div>", "<article>", "<div id='content'>", "<main>"):
        page = f"<html><body><ul><li><a href='/'>Home</a></li></ul>{opening}{sections}{short}</{opening[1:].split()[0].rstrip('>')}><div><a>Next</a></div></body></html>"
        assert htmltext.main_text(page) == want
    # What is none of the article goes, by whatever compound name.
    for name in ("site-footer", "cookie-banner", "ad-slot", "share-buttons", "related-posts", "main-nav", "sidebar2", "newsletter_signup"):
        page = f"<div id='content'>{text}<div class='{name}'><p>Words, more words, and some that nobody wants to read here.</p></div></div>"
        assert htmltext.main_text(f"<html><body>{page}</body></html>") == tidy(first, second), name
    page = f"<div>{text}</div><form><p>Sign up, with your name, to get, every week, some news.</p></form>"
    assert htmltext.main_text(f"<html><body>{page}</body></html>") == tidy(first, second)


def test_deep_and_broken_pages_end():
    assert htmltext.main_text("<div>" * 20_000 + "deep text") == "deep text"
    assert htmltext.main_text("</p></div><b><i><a href='x>y'>t</a>" * 2_000).startswith("t")


# op10


def test_licences_match_brute_force(spark):
    wordings = [("A", "released under the alpha license"), ("B", prose(60, 40)), ("B2", prose(60, 40) + " and some more words")]
    texts = [*odd_texts(), prose(61, 30) + "\n" + prose(60, 40) + "\n" + prose(62, 9), "RELEASED under the Alpha license!", "under the alpha", None]
    docs = frame(spark, [(i, t, "s") for i, t in enumerate(texts)])
    got = {r.doc_id: r.matches for r in licenses.find_licenses(docs, wordings).collect()}
    find = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    pairs = lambda w: set(zip(w, w[1:], strict=False))
    for i, text in enumerate(texts):
        w = find.findall(lower(text))
        best = Counter()
        for name, wording in wordings:
            t = find.findall(lower(wording))
            for at in range(max(1, len(w) - len(t) + 1)):
                x = pairs(w[at : at + len(t)])
                if x:
                    best[name] = max(best[name], 2 * len(x & pairs(t)) / (len(x) + len(pairs(t))))
        top = max(best.values(), default=0)
        assert (max((m.dice for m in got[i]), default=0) == pytest.approx(top)) if top >= 0.8 else not got[i]
    assert licenses.license_report(no_documents(spark)).count() == 0
    assert licenses.license_report(docs).where("doc_id = 16").collect()[0].licenses == ["MIT"]


@pytest.mark.parametrize("seed", range(5))
def test_suffixes_that_share_less_than_a_window_are_not_covered(seed):
    rng = np.random.default_rng(seed)
    left = [bytes(rng.integers(97, 123, 100, dtype=np.uint8)) for _ in range(400)]
    shared = np.array([0, *rng.integers(100, 105, 399)])
    nearest, farthest = suffixes._covered(shared, np.full(400, 200), left, np.zeros(400, bool))
    assert (nearest == -1).all() and (farthest == -1).all()


def test_bytes_before_anchors_are_grouped_exactly():
    rng = np.random.default_rng(1)
    back = rng.integers(0, 2, (300, 100)).astype(np.uint8)
    back[50:90] = back[0]
    back[60:70, 37] ^= 1
    order, agree = suffixes._sorted_back(back)
    for d in (0, 1, 5, 37, 38, 100):
        same = np.empty(300, np.int64)
        same[order] = np.cumsum(agree < d)
        pairs = [(i, j) for i in range(300) for j in range(i) if i % 7 == 0]
        assert all((same[i] == same[j]) == (back[i, :d] == back[j, :d]).all() for i, j in pairs)


@pytest.mark.parametrize("bucket_bytes", [1 << 30, 3_000])
def test_token_counts_do_not_depend_on_buckets(spark, monkeypatch, bucket_bytes):
    public = pytest.importorskip("public_tokenizers")
    path = public.path("byte_bpe_50k.json")
    monkeypatch.setattr(tokencounts, "BUCKET_BYTES", bucket_bytes)
    docs = frame(spark, [(i, prose(100 + i, 300), "s") for i in range(40)])
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    want = {i: len(tok.encode(prose(100 + i, 300), add_special_tokens=False)) for i in range(40)}
    assert {r.doc_id: r.n_tokens for r in tokencounts.token_counts(docs, path, public.PATTERN).collect()} == want
