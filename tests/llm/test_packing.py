import itertools
import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tallybrook.llm import packing
from tallybrook.llm.common import WordTokenizer, stored, vocabulary_file
from tallybrook.llm.packing import fullest_window, minimum_slack_plan, pack, pack_documents, padding, token_pieces
from tallybrook.llm.token_files import best_fit_decreasing, round_trip, token_matrix


@pytest.fixture(scope="module")
def tokenizer():
    return WordTokenizer(vocabulary_file())


def ids_of(tokenizer, text):
    return tokenizer.tokenizer.encode(text or "", add_special_tokens=False).ids + [2]


class Counted:
    """A tokenizer that counts the texts given to it."""

    def __init__(self, tokenizer):
        self.tokenizer, self.texts = tokenizer, 0

    def encode_batch_fast(self, texts, **options):
        self.texts += len(texts)
        return self.tokenizer.encode_batch_fast(texts, **options)


LETTERS = "abcdefghijklmnopqrstuvwxyzßàéîõüÿđłœȝÉØ"


def test_words_of_letters_are_encoded_together(tokenizer):
    rng = random.Random(3)
    words = list(dict.fromkeys("".join(rng.choices(LETTERS, k=rng.randrange(1, 12))) + rng.choice(["", "", "...", "***", ",$$$"]) for _ in range(6000)))
    own = WordTokenizer(vocabulary_file())
    own.tokenizer = Counted(own.tokenizer)
    ids, counts = own.encode(pa.array([" ".join(words), None, words[0]], pa.string()))
    want = [tokenizer.tokenizer.encode(x, add_special_tokens=False).ids for x in (" ".join(words), "", words[0])]
    assert ids.tolist() == sum(want, []) and counts.tolist() == [len(x) for x in want]
    assert own.tokenizer.texts < 100


def test_a_vocabulary_without_marks_of_ends(tmp_path):
    from tokenizers import Tokenizer, models, pre_tokenizers

    plain = Tokenizer(models.BPE({x: i for i, x in enumerate([*"abc", "ab"])}, [("a", "b")]))
    plain.pre_tokenizer = pre_tokenizers.Whitespace()
    plain.save(path := str(tmp_path / "plain.json"))
    ids, counts = WordTokenizer(path).encode(pa.array(["ab cab a", "", "bca zz ab"], pa.string()))
    want = [plain.encode(x).ids for x in ("ab cab a", "", "bca zz ab")]
    assert ids.tolist() == sum(want, []) and counts.tolist() == [len(x) for x in want]


def test_ids_by_words_are_those_of_whole_texts(tokenizer, texts, prose):
    hard = ["<|endoftext|>A <|ENDOFTEXT|>.", "don't DON'T 'll.'s", "Á. ́x", "a)., b!? ... ., ½. ². İ.", "3.5,7 x.y."]
    many = [*texts, *hard, *[prose(s, 300) for s in range(5)]]
    for limit in (40, 800_000):
        own = WordTokenizer(vocabulary_file(), limit)
        for _ in range(2):
            ids, counts = own.encode(pa.array(many, pa.string()))
            ends = np.cumsum(counts)
            for text, e, n in zip(many, ends, counts, strict=True):
                assert ids[e - n : e].tolist() == ids_of(tokenizer, text)[:-1]


def test_the_fullest_window_is_found():
    r = random.Random(5)
    for _ in range(300):
        capacity = r.randint(3, 30)
        lengths = [r.randint(1, capacity) for _ in range(r.randint(1, 8))]
        counts = {n: lengths.count(n) for n in lengths}
        chosen = dict(fullest_window(counts, capacity))
        assert all(0 < k <= counts[n] for n, k in chosen.items()) and max(lengths) in chosen
        rest = sorted(lengths)[:-1]
        sums = {sum(c) for k in range(len(rest) + 1) for c in itertools.combinations(rest, k)}
        assert sum(n * k for n, k in chosen.items()) == max(lengths) + max(s for s in sums if s <= capacity - max(lengths))


def test_a_plan_uses_each_piece_once_and_its_size_is_bounded():
    r = random.Random(6)
    for n in (1, 50, 5_000, 500_000):
        counts = {k: r.randint(1, max(1, n // 64)) for k in range(1, 65)}
        plan = minimum_slack_plan(counts, 64)
        used: dict[int, int] = {}
        for chosen, times in plan:
            assert sum(k * m for k, m in chosen) <= 64
            for k, m in chosen:
                used[k] = used.get(k, 0) + m * times
        assert used == counts and len(plan) < 1_000
    assert minimum_slack_plan({}, 64) == []


@pytest.mark.parametrize("window", [16, 4096])
def test_packed_pieces_hold_all_ids(documents, texts, tokenizer, window):
    rows = pack_documents(documents(texts), window=window).collect()
    expected = {i: ids_of(tokenizer, t) for i, t in enumerate(texts)} | {None: ids_of(tokenizer, "a text without an id")}
    copies = {0: 3, None: 2}
    seen, places = {}, {}
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length <= window and zlib.crc32(r.ids) == r.ids_crc32
        assert ids == expected[r.doc_id][r.start : r.start + r.length] and r.doc_tokens == len(expected[r.doc_id])
        seen[r.doc_id] = seen.get(r.doc_id, 0) + r.length
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert seen == {i: len(x) * copies.get(i, 1) for i, x in expected.items()}
    for spots in places.values():
        end = 0
        for offset, length in sorted(spots):
            assert offset == end
            end += length
        assert end <= window
    assert sorted(places) == list(range(len(places)))


def test_no_documents_no_pieces(documents):
    packed = pack_documents(documents([]))
    assert packed.collect() == [] and padding(packed).collect()[0] == (0, 0, 0)


def test_real_documents_fill_their_windows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = padding(pack_documents(docs)).first()
    assert found.padding < 0.01 * found.tokens


def brute_best_fit(lengths, window):
    room = []
    for n in sorted(lengths, reverse=True):
        fits = [(r, i) for i, r in enumerate(room) if r >= n]
        if fits:
            room[min(fits)[1]] -= n
        else:
            room.append(window - n)
    return sorted(room)


def test_best_fit_decreasing_as_by_brute_force():
    r = random.Random(7)
    for _ in range(200):
        window = r.randint(2, 60)
        lengths = np.array([r.randint(1, window) for _ in range(r.randint(1, 60))])
        bins, n = best_fit_decreasing(lengths, window)
        fill = np.bincount(bins, weights=lengths, minlength=n).astype(int)
        assert sorted((window - fill).tolist()) == brute_best_fit(lengths.tolist(), window)


@pytest.mark.parametrize("window, group", [(16, 100), (2048, 4 << 20)])
def test_token_files_read_back(documents, texts, tokenizer, window, group):
    rows = round_trip(documents(texts), window=window, group_tokens=group).collect()
    expected = {i: ids_of(tokenizer, t) for i, t in enumerate(texts)} | {None: ids_of(tokenizer, "a text without an id")}
    seen = {}
    for r in rows:
        assert np.frombuffer(r.ids, "<u4").tolist() == expected[r.doc_id][r.start : r.start + r.length]
        assert np.frombuffer(r.positions, "<u2").tolist() == list(range(r.length))
        seen[r.doc_id] = seen.get(r.doc_id, 0) + r.length
    assert seen == {i: len(x) * {0: 3, None: 2}.get(i, 1) for i, x in expected.items()}
    assert round_trip(documents([])).collect() == []


def test_rows_of_the_matrix_are_whole_and_padded(documents, texts):
    for r in token_matrix(documents(texts), window=64, pad_id=9).collect():
        assert len(r.ids) == 4 * 64 and len(r.positions) == 2 * 64
        assert r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens and r.cu_seqlens == sorted(set(r.cu_seqlens))
        assert len(r.doc_ids) == len(r.starts) == len(r.cu_seqlens) - 1
        assert set(np.frombuffer(r.ids, "<u4")[r.n_tokens :].tolist()) <= {9}
    with pytest.raises(ValueError, match="65536"):
        token_matrix(documents(texts), window=1 << 17)


def test_pieces_have_the_same_places_when_ranks_are_shuffled(documents, texts, monkeypatch, plan):
    pieces = stored(token_pieces(documents(texts * 3), window=64), "pieces")
    places = lambda: sorted((str(r.doc_id), r.start, r.ids_crc32, r.sequence_id, r.offset) for r in pack(pieces, 64).collect())
    broad = places()
    monkeypatch.setattr(packing, "BROADCAST_STARTS", 0)
    assert "ShuffledHashJoin" in plan(pack(pieces, 64))
    assert places() == broad


def test_text_tokenized_at_once_takes_little_memory(prose):
    from tallybrook.llm.common import slices

    text = pa.array([prose(s, 1_000) for s in range(800)], pa.string())
    batch = pa.RecordBatch.from_arrays([text], names=["text"])
    own, most = WordTokenizer(vocabulary_file()), 0
    assert text.nbytes > 5 << 20
    own.encode(text.slice(0, 1))
    for _, part in slices(batch, text, packing.TOKENIZED_BYTES):
        tracemalloc.start()
        own.encode(part)
        most = max(most, tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert most < 24 << 20
