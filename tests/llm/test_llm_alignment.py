"""Token alignment against plain Python over whole texts."""

import base64
import random
import tracemalloc
from collections import Counter
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken

from ledgersift.llm.alignment import LONG, Encoders, align, parts, score_links, slices
from ledgersift.llm.pieces import MODEL
from ledgersift.llm.queries import QUERIES
from ledgersift.llm.wordpiece import VOCABULARY


@pytest.fixture(scope="module")
def plain():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    a = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return a, sentencepiece.SentencePieceProcessor(model_file=MODEL)


def spell(p, i):
    piece = p.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if p.is_byte(i) else piece.replace("▁", " ").encode()


def spans(pieces):
    at, out = 0, []
    for i, raw in pieces:
        out.append((i, at, at + len(raw)))
        at += len(raw)
    return out


def brute(plain, texts):
    """Per text: (n_a, n_b, groups, links), links by comparing byte ranges."""
    enc, p = plain
    out = []
    for text in texts:
        a = [(i, enc.decode_single_token_bytes(i)) for i in enc.encode_ordinary(" " + text)] if text else []
        b = [(i, spell(p, i)) for i in p.encode(text)] if text else []
        said = (" " + (text or "")).encode()
        if not text or b"".join(r for _, r in a) != said or b"".join(r for _, r in b) != said:
            out.append((0, 0, [], []))
            continue
        a, b = spans(a), spans(b)
        ends = sorted({x[2] for x in a} & {x[2] for x in b})
        groups, links, i, j = [], [], 0, 0
        for end in ends:
            own_a, own_b = [], []
            while i < len(a) and a[i][2] <= end:
                own_a.append(a[i])
                i += 1
            while j < len(b) and b[j][2] <= end:
                own_b.append(b[j])
                j += 1
            groups.append(",".join(str(x[0]) for x in own_a) + "|" + ",".join(str(x[0]) for x in own_b))
            links += [(x[0], y[0]) for x in own_a for y in own_b if x[1] < y[2] and y[1] < x[2]]
        out.append((len(a), len(b), groups, links))
    return out


def digests(found):
    holds = Counter(pair for *_, links in found for pair in set(links))
    most = {}
    for (a, _), n in holds.items():
        most[a] = max(most.get(a, 0), n)
    rows = []
    for n_a, n_b, groups, links in found:
        said = ";".join(groups)
        best = sum(holds[x] == most[x[0]] for x in links)
        rows.append((n_a, n_b, len(groups), len(links), best, sum(holds[x] for x in links), sha256(said.encode()).hexdigest() if said else ""))
    return rows


NAMES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_query_by_brute_force(spark, sf, plain):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf['sf0.01']}/documents.parquet").collect()}
    expected = dict(zip(texts, digests(brute(plain, texts.values())), strict=True))
    found = {r.doc_id: tuple(r[n] for n in NAMES) for r in QUERIES["op13_token_alignment"](spark, sf["sf0.01"]).collect()}
    assert found == expected


SPECIAL = [
    None,
    "",
    " ",
    "  two  spaces \n\n lines\t",
    "a ▁ mark",
    "<|endoftext|> <s> </s> <unk> <0x41> plain",
    "é中文 \U0001f600\U0001f600 ñ zero​width \x00 nul",
    "supercalifragilistic antidisestablishment 12345678901234567890",
    "x" * 3000,
]


def test_edges_by_brute_force(spark, plain):
    texts = [*SPECIAL, "word and others, " * (LONG // 5), *SPECIAL[5:]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = score_links(align(docs)).orderBy("doc_id").collect()
    expected = digests(brute(plain, texts))
    got = [(r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, sha256(r.token_groups.encode()).hexdigest() if r.token_groups else "") for r in found]
    assert got == expected
    for r, text in zip(found, texts, strict=True):
        assert len(r.a_ids) == r.n_a and len(r.b_ids) == r.n_b
        assert r.text == text
    assert expected[4][0] == 0 and expected[5][0] > 0


def test_long_texts_are_cut_where_nothing_changes(plain):
    text = "The first, the second  and\nthird one's " * 5000
    assert len(parts(text, 1000)) > 50 and "".join(parts(text, 1000)) == " " + text
    e = Encoders(VOCABULARY, MODEL)
    (a,), (b,) = e([text])
    assert a == plain[0].encode_ordinary(" " + text) and b == plain[1].encode(text)


def test_ranks_and_merges_agree():
    """On letters of settled kind both ways of encoding give the same ids."""
    e = Encoders(VOCABULARY, MODEL)
    assert e.fast is not None
    rng = random.Random(9)
    letters = [chr(c) for c in [9, 10, 13, *range(32, 127), *range(0xA1, 0x180)]]
    common = [*"etaoinshrdlu", " ", " ", " ", "'", "'s", "\n", "1", "é"]
    for k in range(3000):
        text = "".join(rng.choices(letters if k % 2 else common, k=rng.randrange(1, 120)))
        assert e.fast.encode_ordinary(text) == e.a.encode(text, add_special_tokens=False).ids


def test_empty_table_and_clashing_columns(spark):
    assert score_links(align(spark.createDataFrame([], "doc_id long, text string"))).collect() == []
    docs = spark.createDataFrame([(None, "one two", "u", 5.0), (None, "one two", "u", 5.0), (3, None, None, None)], "doc_id long, text string, N_A string, n double")
    found = score_links(align(docs, keep_text=False)).orderBy("doc_id").collect()
    assert [(r.n, r.n_a) for r in found] == [(5.0, 2), (5.0, 2), (None, 0)]
    assert [r.count_sum for r in found] == [4, 4, 0]
    assert "N_A" not in found[0].asDict() and "text" not in found[0].asDict()


def test_common_ends_keep_no_index_in_dictionaries():
    """They took a quarter of the operator's time, and most of its memory."""
    rng = np.random.default_rng(2)
    ends_a, ends_b = (np.cumsum(rng.integers(1, 9, 100_000)) for _ in range(2))
    tracemalloc.start()
    common, cut_a, cut_b = slices(ends_a, ends_b)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert common.tolist() == sorted({*ends_a.tolist()} & {*ends_b.tolist()})
    assert (ends_a[cut_a - 1] == common).all() and (ends_b[cut_b - 1] == common).all()
    assert peak < 22_000_000
