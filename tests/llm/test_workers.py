"""What Python workers hold between and within tasks."""

import sys
import tracemalloc
import types

import numpy as np
import pyarrow as pa
import pytest

from marketlens.llm import jaccard_join, shingles, token_files, toxicity, workers
from marketlens.llm.queries import tokenizer_path


def test_a_value_is_made_once_until_it_is_dropped():
    made = []
    for _ in range(2):
        assert workers.kept("test", lambda: made.append(1) or len(made)) == 1
    workers.start_afresh()
    assert workers.kept("test", lambda: made.append(1) or len(made)) == 2
    workers.start_afresh()
    assert workers._MODULE not in sys.modules


@pytest.mark.parametrize("stage", ["toxicity", "shingles"])
def test_a_stage_drops_what_an_earlier_one_kept(spark, frame, stage):
    def fill(batches):
        workers.kept("something", lambda: "x")
        yield from batches

    def holds(batches):
        for _ in batches:
            yield pa.RecordBatch.from_pydict({"held": [workers._MODULE in sys.modules]})

    docs = frame("doc_id bigint, text string", (1, "a b c d e f"), (2, None)).coalesce(1)
    # all of them in one worker after another, as tasks of one partition are
    for _ in range(2):
        docs.mapInArrow(fill, docs.schema).collect()
    if stage == "toxicity":
        toxicity.score(docs, toxicity.Model({})).collect()
        assert not docs.mapInArrow(holds, "held boolean").first()["held"]
    else:
        found = jaccard_join.shared_shingles(docs, "doc_id", "text", 5, 75)
        assert sorted((r["id"], r["n"]) for r in found.collect()) == [(1, 2), (2, 0)]


def test_texts_are_numbered_in_small_parts(monkeypatch):
    seen, number = [], shingles.word_numbers
    monkeypatch.setattr(shingles, "word_numbers", lambda t: (seen.append(sum(map(len, t))), number(t))[1])
    texts = [b"w%d " % i * 20_000 for i in range(30)]
    found = list(shingles.shingle_sets(texts))
    assert [len(s) for s in found] == [1] * 30
    assert max(seen) <= 600_000 and sum(seen) == sum(map(len, texts))


def test_words_beyond_ascii_are_spelled_as_the_tokenizer_does():
    encoder = token_files.Encoder(tokenizer_path())
    letters = "".join(chr(c) for c in [*range(0xA1, 0x250), *range(0x391, 0x450), 0x4E2D, 0x1F600])
    words = [letters[i : i + n] for n in (1, 2, 5) for i in range(0, len(letters), n)]
    texts = [" ".join(words), *words[:200], ", ".join(words)]
    ids, sizes = encoder(texts)
    expected = [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert ids.tolist() == [i for e in expected for i in e] and sizes.tolist() == [len(e) for e in expected]


def test_line_ends_and_marks_do_not_make_new_words():
    encoder = token_files.Encoder(tokenizer_path())
    encoder(["x first second third. y."])
    seen, model, batch = [], encoder.tokenize, encoder.tokenizer.encode_batch_fast
    encoder.tokenize = lambda t: (seen.append(t), model(t))[1]
    encoder.tokenizer = types.SimpleNamespace(encode_batch_fast=lambda t, **k: (seen.extend(t), batch(t, **k))[1])
    texts = ["first.\nsecond third.\nthird first.", "third.\nthird", "third\n\nthird", "second first\n"]
    ids, sizes = encoder(texts)
    # a word that no space precedes has ids of its own; only what the tokenizer cuts goes to it whole
    assert sorted(seen) == sorted(["\n", "first", "second", "third", "third\n\nthird", " first\n"])
    expected = [token_files.Encoder(tokenizer_path()).tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert ids.tolist() == [i for e in expected for i in e] and sizes.tolist() == [len(e) for e in expected]


def test_what_is_remembered_is_bounded(monkeypatch):
    monkeypatch.setattr(token_files, "MOST_PARTS", 40)
    encoder = token_files.Encoder(tokenizer_path())
    for i in range(30):
        texts = [f"in every word{'abcdefghij'[i % 10]}", " ".join("xyz"[j % 3] * (i + j + 1) for j in range(9)) + f".\n{i}"]
        ids, _ = encoder(texts)
        expected = [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert ids.tolist() == [i for e in expected for i in e]
        assert len(encoder.number) < 40 + 20 and "every" in encoder.number


def test_pairs_are_found_by_their_hash():
    draw = np.random.default_rng(5)
    pairs = np.unique(draw.integers(0, 1 << 32, 60_000, dtype=np.uint32))
    slots = token_files._slots(pairs)
    first = np.unique(slots, return_index=True)[1]
    # pairs of one slot: some looked for, some not
    best, other = np.sort(pairs[draw.permutation(len(pairs))[:15_000]]), pairs
    assert len(first) < len(pairs)
    place = token_files._places(best, other)
    expected = np.isin(other, best)
    assert ((best[place] == other) == expected).all()


def test_the_model_is_taken_from_the_tokenizer_once(monkeypatch):
    encoder = token_files.Encoder(tokenizer_path())
    expected = encoder.tokenizer.encode("some plain words", add_special_tokens=False).ids
    whole = types.SimpleNamespace(encode_batch_fast=encoder.tokenizer.encode_batch_fast)
    encoder.tokenizer = whole  # words after a space go to the model, which is bound
    assert encoder(["some plain words"])[0].tolist() == expected


def test_texts_go_to_the_encoder_in_small_batches(spark, frame, folder, monkeypatch):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before, seen = spark.conf.get(key, None), []
    write = type(spark.range(1).write).parquet
    monkeypatch.setattr(
        type(spark.range(1).write), "parquet", lambda self, *p, **o: (seen.append(spark.conf.get(key)), write(self, *p, **o))[1]
    )
    token_files.write_tokens(frame("doc_id bigint, text string", (1, "a b")), folder, tokenizer_path())
    assert [int(x.rstrip("b")) <= token_files.SLICE_BYTES for x in seen] == [True]
    assert spark.conf.get(key, None) == before


def test_a_shard_takes_little_memory_to_write():
    tokens = np.random.default_rng(7).integers(0, 2000, 400_000).astype(np.uint16)
    tracemalloc.start()
    try:
        token_files.write_shard([1, 2], np.array([150_000, 250_000]), tokens)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 39 * len(tokens)  # bytes a token
