"""Edge cases of the operators on texts: nulls, empty and long texts, ties,
repeated rows, empty tables, and columns with clashing names."""

import json
import random
from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgersift.llm.chat import escape, format_chats, parse, read_back, render, unescape
from ledgersift.llm.contamination import Finder, best_match, find_benchmark
from ledgersift.llm.language import codewords, fit, predict
from ledgersift.llm.lines import PerfectHash, dedup_lines
from ledgersift.llm.pieces import Codec, Memo, SideBySide, StreamingViterbi, Vocabulary, decode_pieces, encode_pieces
from ledgersift.llm.wordpiece import VOCABULARY, Automaton, byte_letters, load, token_counts

LONG = "a long line that stands in many documents, x" * 3


def documents(spark, rows, extra=""):
    return spark.createDataFrame(rows, f"doc_id long, text string{extra}")


# Lines.


def brute_lines(rows, least=5, short=40):
    def key(line):
        k = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))
        return k if len(k) >= short else None

    holds: dict = {}
    for n, (i, text) in enumerate(rows):
        for k in {key(x) for x in (text or "").split("\n")} - {None}:
            holds.setdefault(k, []).append((i, n))
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        stay = [x for x in lines if key(x) is None or len(holds[key(x)]) < least or max(h[0] for h in holds[key(x)]) == i]
        out.append((i, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out)


def test_lines_by_brute_force(spark):
    rng = random.Random(3)
    pool = [LONG + str(k) for k in range(12)] + ["short", "", " " + LONG.upper() + "0 \t"]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randrange(6)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "y" * 200_000 + "\n" + LONG)]
    found = dedup_lines(documents(spark, rows), keys_per_shard=4, asked_per_task=8)
    got = sorted((r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in found.collect())
    assert got == brute_lines(rows)


def test_lines_ties_nulls_and_clashes(spark):
    rows = [(7, LONG, "a")] * 3 + [(1, LONG, "b"), (2, LONG, "c"), (None, LONG, "d"), (9, None, "e")]
    found = dedup_lines(documents(spark, rows, ", n_lines string")).collect()
    assert sorted(r.doc_id for r in found if r.text == LONG) == [7, 7, 7]
    assert {r.n_lines for r in found} == {1}
    assert [r.text for r in found if r.doc_id == 9] == [None]
    assert dedup_lines(documents(spark, [])).collect() == []


def test_perfect_hash_is_minimal():
    keys = np.random.default_rng(0).integers(0, 2**63, (5000, 2)).astype(np.uint64)
    index = PerfectHash.build(keys)
    assert sorted(index.slots(keys).tolist()) == list(range(5000))
    assert PerfectHash.build(keys[:0]).slots(keys[:3]).tolist() == [-1] * 3


# SentencePiece.

SMALL = Vocabulary({p: (i + 256, s) for i, (p, s) in enumerate({"▁": -3.0, "a": -2.0, "b": -2.0, "ab": -3.0, "ba": -3.5, "▁a": -4.0, "aab": -4.5, "abab": -6.0, "▁ab": -5.0}.items())}, list(range(256)))
CROSSING = Vocabulary({**SMALL.pieces, "b▁a": (300, -1.0)}, list(range(256)))


def whole_search(v, text):
    """Scores of all prefixes at once; ties as in the streaming search."""
    best = [(0.0, [])]
    for end in range(1, len(text) + 1):
        at = None
        for start in range(max(0, end - v.longest), end):
            part = text[start:end]
            found = v.pieces.get(part)
            if found is None and end - start == 1:
                found = (None, v.unknown)
            if found is None:
                continue
            score = best[start][0] + found[1]
            if at is None or score > at[0]:
                ids = [found[0]] if found[0] is not None else list(part.encode())
                at = (score, best[start][1] + ids)
        best.append(at)
    return best[-1][1]


@given(st.text("ab▁xé", max_size=60), st.integers(1, 7))
@settings(max_examples=150, deadline=None)
def test_streaming_search_is_the_whole_search(text, step):
    search, out = StreamingViterbi(SMALL), []
    for k in range(0, len(text), step):
        out += search.feed(text[k : k + step])
    out += search.finish()
    assert out == whole_search(SMALL, text)


@given(st.text("ab xé▁\n", max_size=40))
@settings(max_examples=100, deadline=None)
def test_codec_round_trip(text):
    for v in (SMALL, CROSSING):
        coder = Codec(v)
        ids = np.frombuffer(coder.encode([text])[0], np.int32).tolist()
        assert coder.decode(ids) == text
        if "▁" not in text and text:
            assert ids == whole_search(v, "▁" + text.replace(" ", "▁"))


@given(st.lists(st.text("ab▁xé\n\0\U0001f600", min_size=1, max_size=20), min_size=1, max_size=30))
@settings(max_examples=100, deadline=None)
def test_segments_side_by_side_are_searched_alike(segments):
    for v in (SMALL, CROSSING, Vocabulary({}, list(range(256)))):
        many = SideBySide(v)
        many.ROWS = 8
        assert [np.frombuffer(x, np.int32).tolist() for x in many.search(segments)] == [whole_search(v, s) for s in segments]


def test_a_full_memo_starts_anew():
    memo = Memo(SMALL, 3)
    for words in ({"▁a", "▁b"}, {"▁a", "▁ab"}, {"▁x", "▁xa"}, {"▁" + "a" * 70}):
        memo.learn(words)
        assert len(memo) <= 3
        assert all(np.frombuffer(memo[w], np.int32).tolist() == whole_search(SMALL, w) for w in words)


def test_window_and_what_is_held_stay_small():
    """Scores are kept for the longest piece; back pointers until paths meet,
    here at every mark."""
    search = StreamingViterbi(SMALL)
    most = 0
    for _ in range(3000):
        list(search.feed("▁abaab"))
        assert len(search.scores) <= SMALL.longest
        most = max(most, len(search.back))
    assert most <= 4 * SMALL.longest + 6


def test_library_agrees(tmp_path):
    """The library's own search over the same pieces, as a unigram model."""
    import sentencepiece

    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    from ledgersift.llm.pieces import MODEL

    model = pb.ModelProto()
    model.ParseFromString(open(MODEL, "rb").read())
    model.trainer_spec.model_type = 1
    path = tmp_path / "unigram.model"
    path.write_bytes(model.SerializeToString())
    theirs = sentencepiece.SentencePieceProcessor(model_file=str(path))
    ours = Codec(Vocabulary.load(MODEL))
    scores = {i: s for i, s in ours.v.pieces.values()}
    for text in ["The there and then, of nations.", "Éan de aiê la parêtre", "x  y", "internationalization of everything"]:
        a = np.frombuffer(ours.encode([text])[0], np.int32).tolist()
        b = theirs.encode(text)
        assert sum(scores.get(i, 0) for i in a) >= sum(scores.get(i, 0) for i in b) - 1e-3


def test_pieces_of_nulls_and_clashes(spark):
    rows = [(1, None, 5), (2, "", 6), (3, "a b▁c\u0000\U0001f600", 7), (3, "a b▁c\u0000\U0001f600", 7), (4, "z" * 100_000, 8)]
    found = decode_pieces(encode_pieces(documents(spark, rows, ", piece_ids int"))).collect()
    assert [(r.doc_id, r.decoded) for r in found] == [(a, b) for a, b, _ in rows]
    assert found[0].piece_ids is None and found[1].piece_ids == []
    assert encode_pieces(documents(spark, [])).collect() == []


# Token counts.


def vocabulary(path):
    letters = byte_letters()
    pieces = [p for p in json.load(open(path, encoding="utf-8"))["model"]["vocab"] if all(c in letters for c in p)]
    raw = lambda p: bytes(letters[c] for c in p)
    initial = {raw(p[1:]) for p in pieces if p[0] == "Ġ"} | {bytes([b]) for b in range(256)}
    return initial - {b""}, {raw(p) for p in pieces if p[0] != "Ġ"}


def greedy(word, initial, inner):
    n, at = 0, 0
    while at < len(word):
        pieces = initial if at == 0 else inner
        for end in range(len(word), at, -1):
            if word[at:end] in pieces:
                break
        else:
            return 1
        n, at = n + 1, end
    return n


@given(st.sets(st.binary(min_size=1, max_size=5).map(lambda b: bytes(97 + x % 3 for x in b)), max_size=12), st.sets(st.binary(min_size=1, max_size=5).map(lambda b: bytes(97 + x % 3 for x in b)), max_size=12), st.text("abc", max_size=12))
@settings(max_examples=300, deadline=None)
def test_automaton_counts_as_greedy_matching(initial, inner, word):
    assert Automaton(sorted(initial), sorted(inner)).count(word.encode()) == greedy(word.encode(), initial, inner)


def test_token_counts_of_nulls_and_clashes(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, " \t\n", "x"), (4, "hello  world\x0bx", "x"), (4, "hello  world\x0bx", "x"), (5, "q" * 50_000, "x")]
    found = token_counts(documents(spark, rows, ", n_tokens string")).collect()
    assert [r.n_words for r in found] == [0, 0, 0, 3, 3, 1]
    assert found[3].n_tokens == sum(greedy(w, *vocabulary(VOCABULARY)) for w in (b"hello", b"world", b"x"))
    assert found[5].n_tokens == load(VOCABULARY).count(b"q" * 50_000) > 1000
    assert token_counts(documents(spark, [])).collect() == []


# Decontamination.


def edit_in(item, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


@given(st.text("abc", min_size=1, max_size=80), st.text("abc", max_size=120))
@settings(max_examples=150, deadline=None)
def test_bit_parallel_distance(item, text):
    assert best_match(item, text)[0] == min(len(item), edit_in(item, text))


def test_edits_within_the_budget_are_found():
    rng = random.Random(5)
    for _ in range(60):
        item = "".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(40, 120))).strip()
        item = " ".join(item.split())
        text = list(item)
        for _ in range(int(len(item) * 0.05)):
            at = rng.randrange(len(text))
            text[at : at + 1] = rng.choice([[], ["x"], [text[at], "y"]])
        inside = "".join(rng.choice("klm ") for _ in range(50)) + "".join(text) + "zzz"
        found = Finder([(1, item)], 0.05).find(inside)
        assert len(found) == 1 and found[0][1] == edit_in(item, inside)


def test_contamination_of_nulls_ties_and_passes(spark):
    item = "the quick brown fox jumps over the lazy dog again and again"
    bench = spark.createDataFrame([(1, item), (2, item.upper()), (3, None), (4, "short"), (None, item), (5, "another benchmark item which is long enough to count")], "item_id long, text string")
    rows = [(1, None, 1), (2, "", 1), (3, "Well:  the QUICK brown\nfox jumped over the lazy dog again and again!", 1), (4, "nothing", 1), (4, "nothing", 1)]
    docs = documents(spark, rows, ", benchmark_hits int")
    for at_once in (100, 1):
        found = find_benchmark(docs, bench, items_at_once=at_once).collect()
        assert [[h.item_id for h in r.benchmark_hits] for r in found] == [[], [], [1, 2], [], []]
        assert {h.distance for h in found[2].benchmark_hits} == {2}
    assert find_benchmark(docs.limit(0), bench).collect() == []
    assert find_benchmark(docs, bench.limit(0)).count() == 5


# Language.


def test_codewords_are_apart():
    for n in (2, 3, 4, 6, 9, 20):
        code = codewords(n)
        assert code.shape[0] == n
        apart = [(code[i] != code[j]).sum() for i in range(n) for j in range(i)]
        assert min(apart) >= max(1, code.shape[1] // 4)


def test_language_by_text_alone(spark):
    rng = random.Random(1)
    words = {"aa": "kala pata mata sala".split(), "bb": "strunz grumpf knarz".split(), "cc": "oui éau où çe".split()}
    say = lambda lang: " ".join(rng.choice(words[lang]) for _ in range(40))
    rows = [(i, say(lang), lang) for i, lang in enumerate(list(words) * 30)]
    docs = documents(spark, rows, ", lang string")
    model = fit(docs, docs.doc_id % 5 != 0)
    assert model.languages == ["aa", "bb", "cc"]
    odd = [(1000, None, "aa"), (1001, "", "aa"), (1002, "123 !?", "aa"), (1003, rows[0][1], None), (1003, rows[0][1], None), (1004, rows[1][1] * 5000, "aa")]
    found = predict(documents(spark, [(*r, "old") for r in rows + odd], ", lang string, score string"), model).collect()
    assert all(r.lang_pred == r.lang for r in found if r.doc_id < 1000)
    assert [r.lang_pred for r in found[len(rows) :]] == ["und", "und", "und", "aa", "aa", "bb"]
    assert all(0 <= r.score <= 1 for r in found)
    alone = predict(documents(spark, [(1003, rows[0][1])]), model).first()
    assert alone.score == found[len(rows) + 3].score
    none = fit(docs.limit(0), docs.doc_id >= 0)
    assert {r.lang_pred for r in predict(docs, none).collect()} == {"und"}


# Chats.


@given(st.lists(st.tuples(st.text("ab\\<>/turn|endoftext\né", max_size=30), st.text("ab\\<>/turn|\n", max_size=40) | st.sampled_from(["</turn>", "<turn>", "<\\turn>", "\\", "<|endoftext|>"])), max_size=5))
@settings(max_examples=200, deadline=None)
def test_conversations_are_read_back(turns):
    text, spans = render(turns)
    assert parse(text) == turns
    assert "".join(unescape(text[a:b]) for a, b in spans) == "".join(t for r, t in turns if r == "assistant")


def test_escaping_leaves_no_control_strings():
    for word in ("<turn>", "</turn>", "<|endoftext|>"):
        assert word not in escape(word * 2 + "\\" + word)


def test_chats_with_nulls_ties_and_long_texts(spark):
    rows = [(1, 1, "assistant", None), (1, 0, "user", "hi"), (2, 0, None, "x"), (2, 0, "assistant", "b é\U0001f600 "), (2, 0, "assistant", "b é\U0001f600 "), (2, None, "assistant", " a"), (3, 0, "assistant", "long " * 40_000), (None, 0, "assistant", "n")]
    turns = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, formatted int")
    found = {r.conv_id: r for r in read_back(format_chats(turns)).collect()}
    assert found[1].loss_chars == 0 and found[1].n_turns == 2
    said = " a" + "b é\U0001f600 " * 2
    assert found[2].loss_sha256 == sha256(said.encode()).hexdigest() and found[2].loss_chars == len(said)
    assert found[3].loss_chars == 200_000 and found[None].n_turns == 1
    assert format_chats(turns.limit(0)).collect() == []


def test_loss_tokens_are_those_of_the_texts(spark):
    turns = spark.createDataFrame([(1, 0, "user", "Question?"), (1, 1, "assistant", "It is so. "), (1, 2, "assistant", "")], "conv_id long, turn long, role string, text string")
    r = format_chats(turns).first()
    from ledgersift.llm.chat import TOKENIZER, tokenizer

    ids = r.token_ids[r.loss_tokens[0].start : r.loss_tokens[0].end]
    assert len(r.loss_tokens) == 1 and tokenizer(TOKENIZER).decode(ids) == "It is so. "
