"""Token ids, files, counts and packing against the tokenizers library."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from playledger.llm import patterns, rans, token_counts, token_files
from playledger.llm.common import flat_texts, text_slices
from playledger.llm.token_ids import PieceTable, encode_texts, piece_starts
from tests.llm.fixtures import awkward_docs, empty_docs

FILES = ("byte_bpe_50k.json", "word_bpe_49k.json")
ALPHABET = ["a", "B", "'s", "'", "'ll", " ", "  ", "\n", "\n\n", ".", ",", "!?", "é", " ", "　", "1", "23", "中",
            "ﬁ", "\t", "\r\n", "—", "n't", "é", "...", "<|endoftext|>", "<|startoftext|>"]


def random_texts(n, most=14, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choices(ALPHABET, k=rng.randint(0, most))) for _ in range(n)]


def reference_ids(name, texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    return [x.ids for x in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.mark.parametrize("name", FILES)
def test_pieces_give_the_ids_of_whole_texts(name):
    texts = random_texts(4000)
    found = []
    batch = pa.record_batch([pa.array(texts)], ["text"])
    for _, data, edges in text_slices(iter([batch]), "text", 5000):
        count, ids = encode_texts(data, edges, public_tokenizers.path(name))
        found += [x.tolist() for x in np.split(ids, np.cumsum(count)[:-1])]
    assert found == reference_ids(name, texts)


def test_a_full_table_starts_again(monkeypatch):
    import playledger.llm.token_ids as module

    monkeypatch.setattr(module, "POOL", 40)
    monkeypatch.setattr(module, "SLOTS", 16)
    table = PieceTable(public_tokenizers.path("byte_bpe_50k.json"))
    for seed in range(30):
        texts = random_texts(6, most=20, seed=seed)
        data, edges = flat_texts(pa.array(texts))
        if not len(data):
            continue
        starts = piece_starts(data, edges)
        _, ids = table.encode(data, starts, np.append(starts[1:], len(data)))
        assert ids.tolist() == [i for x in reference_ids("byte_bpe_50k.json", texts) for i in x]


def test_machine_cuts_where_pieces_start():
    for seed in range(200):
        data, edges = flat_texts(pa.array(random_texts(5, most=200, seed=seed)))
        if len(data):
            assert np.flatnonzero(token_counts.piece_cuts(data, edges)).tolist() == piece_starts(data, edges).tolist()


def test_scan_composes_maps_in_order():
    rng = np.random.default_rng(2)
    maps = rng.integers(0, 4, (37, 4)).astype(np.uint8)
    found, state = token_counts.compose_scan(maps), np.arange(4)
    for k in range(37):
        state = maps[k][state]
        assert found[k].tolist() == state.tolist()


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 64 * 256, 64 * 1024, 64 * 1024 + 1, 150_000])
def test_packets_come_back(n):
    rng = np.random.default_rng(n)
    ids = (rng.pareto(0.7, n) * 3).astype(np.int64) % 50_257
    symbols, counts = np.unique(np.append(ids, 7), return_counts=True)
    table = rans.Table(symbols, counts)
    packet = rans.encode(ids, table)
    assert rans.decode(packet, table).tolist() == ids.tolist()
    if n > 64 * 1024:
        assert rans.decode_segment(packet, table, 0, 3).tolist() == ids[3 * 256 * 64 : 1024 * 64].tolist()


def test_one_symbol_and_damage():
    table = rans.Table(np.array([5]), np.array([9]))
    assert rans.decode(rans.encode(np.full(1000, 5), table), table).tolist() == [5] * 1000
    table = rans.Table(np.arange(300), np.arange(1, 301))
    ids = np.random.default_rng(0).integers(0, 300, 5000)
    packet = bytearray(rans.encode(ids, table))
    packet[-len(packet) // 3] ^= 1  # amid the stream: at its end only filler may stand
    with pytest.raises(ValueError, match="checksum"):
        rans.decode(bytes(packet), table)
    with pytest.raises(ValueError):
        rans.decode(bytes(packet[:-4]), table)


def test_table_keeps_rare_symbols():
    table = rans.Table(np.arange(50_000), np.append(np.full(49_999, 1), 10**12))
    assert int(table.freq.sum()) == 1 << rans.BITS and int(table.freq.min()) == 1


def test_files_hold_the_ids_of_every_row(spark):
    docs = awkward_docs(spark)
    found = token_files.token_file_digests(docs, public_tokenizers.path(FILES[0]), 2).orderBy("start").collect()
    given = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text is not None, r.text or ""))
    start = 0
    for row, doc, ids in zip(found, given, reference_ids(FILES[0], [r.text for r in given]), strict=True):
        ids = [*ids, 2]
        assert (row.doc_id, row.start, row.n_tokens) == (doc.doc_id, start, len(ids))
        assert row.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    assert token_files.token_file_digests(empty_docs(spark), public_tokenizers.path(FILES[0]), 2).count() == 0


def test_counts_are_the_library_s(spark):
    docs = awkward_docs(spark)
    found = sorted(map(tuple, token_counts.token_counts(docs, public_tokenizers.path(FILES[0]), 10).collect()), key=repr)
    rows = docs.collect()
    wanted = [
        (r.doc_id, len((r.text or "").encode()), len(ids), len(ids) > 10)
        for r, ids in zip(rows, reference_ids(FILES[0], [r.text for r in rows]))
    ]
    assert found == sorted(wanted, key=repr)
    assert token_counts.token_counts(empty_docs(spark), public_tokenizers.path(FILES[0]), 10).count() == 0


def test_plan_holds_every_piece_once():
    rng = random.Random(4)
    for capacity in (1, 10, 64, 4096):
        histogram = {rng.randint(1, capacity): rng.randint(1, 50) for _ in range(60)}
        runs = patterns.plan_runs(histogram, capacity)
        held = {}
        for times, lengths in runs:
            assert sum(lengths) <= capacity and times > 0
            for length in lengths:
                held[length] = held.get(length, 0) + times
        assert held == histogram
        total = sum(k * n for k, n in histogram.items())
        assert sum(t for t, _ in runs) <= -(-total // capacity) * 1.1 + 2
    assert patterns.plan_runs({}, 16) == []


def test_patterns_fill_exactly():
    assert patterns.patterns(6, [1, 2, 3, 4]) == [(4, 2), (4, 1, 1), (3, 3), (3, 2, 1), (2, 2, 2)]


def test_least_squares_is_not_negative_and_fits():
    rng = np.random.default_rng(3)
    matrix = rng.integers(0, 3, (8, 20)).astype(float)
    truth = np.maximum(0, rng.normal(size=20))
    x = patterns.least_squares(matrix, matrix @ truth, 3000)
    assert (x >= 0).all() and np.abs(matrix @ x - matrix @ truth).max() < 1e-2


def test_packing_places_every_piece(spark):
    docs = awkward_docs(spark)
    found = patterns.pack(docs, public_tokenizers.path(FILES[1]), 1, 64).toPandas()
    rows = docs.collect()
    wanted = []
    for r, ids in zip(rows, reference_ids(FILES[1], [r.text for r in rows])):
        ids = [*ids, 1]
        for k in range(0, len(ids), 64):
            part = ids[k : k + 64]
            wanted.append((r.doc_id, k // 64, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    got = [tuple(None if v != v else int(v) for v in row) for row in found[columns].itertuples(index=False)]
    assert sorted(got, key=repr) == sorted(wanted, key=repr)
    for _, rows in found.groupby("sequence_id"):
        rows = rows.sort_values("offset")
        assert rows["offset"].tolist() == (rows["length"].cumsum() - rows["length"]).tolist()
        assert rows["length"].sum() <= 64
    assert patterns.pack(empty_docs(spark), public_tokenizers.path(FILES[1]), 1, 64).count() == 0
