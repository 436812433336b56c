"""Operators 4 and 5: token ids, packing and token files."""

import functools
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from barwise.llm.packing import CAPACITY, SegmentTree, best_fit_plan, pack, sequences
from barwise.llm.token_files import read_documents, read_token_files, write_token_files
from barwise.llm.tokens import Encoder, encoder
from tests.llm.cases import awkward, frame

TEXTS = ["it's a \n\n test.  Foo,bar..,  x\t\ty \r\n Éa, été. 'RE 's don't", "a\xa0 b \x0b c\x1c d",
         "<|endoftext|> hi", "  lead", "trail  ", "ſs K ß", "x" * 3000, "日本語。テスト 123 4.5,6",
         "é. ́a ä,", "ÀÉÎ×÷ÿ, a÷, b.", "\n\n\xa0b", "word  \n", "A.B,C;D"]


SPECIAL = ["hello <|endoftext|> world", "<|startoftext|>a<|endoftext|>", "x<|ENDOFTEXT|>y", "a <b> <|endoftext", "<<|endoftext|>>"]


def untouched(name):
    import public_tokenizers
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path(name))


@pytest.mark.parametrize("name, spaces", [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def test_cached_words_give_the_library_s_ids(name, spaces):
    enc, library = encoder(name, spaces), untouched(name)
    for text in TEXTS + SPECIAL + [t for _, t, _ in awkward() if t and len(t) < 5000]:
        assert list(memoryview(enc.encode([text])[0]).cast("I")) == library.encode(text, add_special_tokens=False).ids, text
    assert enc.encode([None, ""]) == [b"", b""]


untouched_once = functools.cache(untouched)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("aB é́.,'!\n\t\xa0 sx1 -÷ßİ")), max_size=30))
def test_cached_words_on_random_texts(text):
    for name, spaces in (("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)):
        ids = untouched_once(name).encode(text, add_special_tokens=False).ids
        assert list(memoryview(encoder(name, spaces).encode([text])[0]).cast("I")) == ids


@pytest.mark.parametrize("name, spaces", [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def test_small_cache_and_small_chunks_are_right(name, spaces):
    import public_tokenizers
    library, texts = untouched(name), ["one two three four one two  three four five\n", " ", "a\n", "\n b"] + TEXTS
    for cache, chunk in ((3, 1 << 20), (3, 1), (100, 7), (100, 40)):
        enc = Encoder(public_tokenizers.path(name), spaces, cache, chunk)
        got = [list(memoryview(x).cast("I")) for x in enc.encode(texts)]
        assert got == [library.encode(t, add_special_tokens=False).ids for t in texts], (cache, chunk)


def plain_best_fit(lengths, capacity):
    """Free space of the bins of best-fit decreasing, piece by piece."""
    free = []
    for n in sorted(lengths, reverse=True):
        fits = [f for f in free if f >= n]
        if fits:
            free.remove(min(fits))
            free.append(min(fits) - n)
        else:
            free.append(capacity - n)
    return sorted(free)


@pytest.mark.parametrize("seed", range(12))
def test_plan_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 37, 100])
    lengths = [rng.randint(1, capacity) for _ in range(rng.choice([1, 20, 400]))]
    counts = {n: lengths.count(n) for n in set(lengths)}
    plan = best_fit_plan(counts, capacity)
    bins = {}
    for n, count in counts.items():
        steps = plan[plan.length == n].sort_values("first").to_dict("records")
        for k in range(count):
            s = [x for x in steps if x["first"] <= k][-1]
            past = k - s["first"]
            bins.setdefault(s["bin"] + past // s["each"], []).append((s["offset"] + past % s["each"] * n, n))
    for places in bins.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= capacity
    used = sorted(capacity - sum(n for _, n in places) for places in bins.values())
    assert used == plain_best_fit(lengths, capacity)


def test_segment_tree_finds_the_tightest():
    tree = SegmentTree(20)
    for v in (3, 7, 20):
        tree.set(v, True)
    assert [tree.first_from(x) for x in (0, 3, 4, 8, 20)] == [3, 3, 7, 20, 20]
    tree.set(20, False)
    assert tree.first_from(8) is None


def test_packing_of_awkward_documents(spark):
    rows = awkward()
    got = pack(frame(spark, rows), with_ids=True).collect()
    enc = encoder("word_bpe_49k.json", False)
    want = []
    for i, text, _ in rows:
        ids = (enc.plain(text) if text else b"") + b"\0\0\0\0"
        for p, at in enumerate(range(0, len(ids), 4 * CAPACITY)):
            part = ids[at:at + 4 * CAPACITY]
            want.append((i, p, at // 4, len(part) // 4, zlib.crc32(part)))
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=repr) == sorted(want, key=repr)
    by_seq = {}
    for r in got:
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length, r.ids))
    whole = {r.sequence_id: r.ids for r in sequences(pack(frame(spark, rows), with_ids=True)).collect()}
    assert set(map(len, whole.values())) <= set(range(1, CAPACITY + 1))
    for places in by_seq.values():
        at = 0
        for offset, n, ids in sorted(places):
            assert offset == at and len(ids) == n
            at += n
        assert at <= CAPACITY
    assert len(by_seq) == len(plain_best_fit([r.length for r in got], CAPACITY))


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_token_files_round_trip(spark, tmp_path, encoding):
    rows = awkward()
    path = str(tmp_path / "tokens")
    write_token_files(frame(spark, rows).repartition(5), path, encoding=encoding)
    got = read_token_files(spark, path).orderBy("start").collect()
    enc = encoder("byte_bpe_50k.json", True)
    at, want = 0, []
    for i, text, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = (enc.plain(text) if text else b"") + b"\0\0\0\0"
        want.append((i, at, len(ids) // 4, zlib.crc32(ids)))
        at += len(ids) // 4
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got] == want
    one = spark.read.parquet(path).where("doc_id = 7").select("ids").first().ids
    assert one == list(memoryview(enc.plain("one two three") + b"\0\0\0\0").cast("I"))
    # encodings, row groups and page indexes are in the files
    import glob
    import pyarrow.parquet as pq
    column = pq.ParquetFile(sorted(glob.glob(path + "/*.parquet"))[0]).metadata.row_group(0).column(2)
    assert any(("DICTIONARY" if encoding == "dictionary" else "DELTA") in e for e in column.encodings)
    assert column.has_offset_index


def test_chosen_documents_touch_their_own_pages(spark, tmp_path):
    path = str(tmp_path / "tokens")
    rows = [(i, f"document {i} " + "word " * (i % 50), None) for i in range(6000)]
    write_token_files(frame(spark, rows), path, page_bytes=4096, page_rows=100)
    wanted = [17, 3000, 5999]
    found = read_documents(spark, path, wanted)
    got = {r.doc_id: r.ids for r in found.collect()}
    library = untouched("byte_bpe_50k.json")
    assert got == {i: library.encode(rows[i][1], add_special_tokens=False).ids + [0] for i in wanted}
    plan = found._jdf.queryExecution().executedPlan()
    plan = plan.finalPhysicalPlan() if hasattr(plan, "finalPhysicalPlan") and "Adaptive" in plan.nodeName() else plan
    read = plan.collectLeaves().head().metrics().apply("numOutputRows").value()
    assert 3 <= read <= 1000  # of 6,000: pages, not files or row groups


def test_files_go_by_number_not_by_name(spark, tmp_path):
    """More files than five digits count: part-100000 comes after part-10001."""
    import pyarrow as pa
    import pyarrow.parquet as pq
    path = tmp_path / "many"
    path.mkdir()
    numbers = [0, 9, 10001, 99999, 100000, 100001]
    for k, n in enumerate(numbers):
        table = pa.table({"doc_id": pa.array([k], pa.int64()), "n_tokens": pa.array([k + 1], pa.int64()),
                          "ids": pa.array([[7] * (k + 1)], pa.list_(pa.int32()))})
        pq.write_table(table, path / f"part-{n:05d}-x.parquet")
    got = sorted((r.doc_id, r.start, r.n_tokens) for r in read_token_files(spark, str(path)).collect())
    assert got == [(k, k * (k + 1) // 2, k + 1) for k in range(len(numbers))]


def test_empty_tables(spark, tmp_path):
    assert pack(frame(spark, [])).collect() == []
    path = str(tmp_path / "none")
    write_token_files(frame(spark, []), path)
    assert read_token_files(spark, path).collect() == []
