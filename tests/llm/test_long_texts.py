"""Very long texts: white space without end, thousands of notices."""

import random
import time

import public_tokenizers
import pytest
import tiktoken

from tidemark.llm import separator_scan
from tidemark.llm.license_scan import PHRASES, TEMPLATES, LicenceScanner, _uncovered, scan_licences
from tidemark.llm.queries import MULTI_VOCABULARY, SEPARATOR
from tidemark.llm.separator_scan import scan_token_files, token_ids, write_token_files
from tidemark.llm.tree_bpe import read_ranks

LONG = ["\n" * 1_000_000, " " * 1_000_000, "a " + "\n \t" * 400_000 + " b", "x" * 300_000]


def test_token_files_of_endless_white_space(spark, tmp_path):
    rows = list(enumerate(LONG)) + [(10, None), (None, "one two")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    path = str(tmp_path / "t")
    write_token_files(df, path, MULTI_VOCABULARY, public_tokenizers.PATTERN, SEPARATOR)
    found = {r.id: r.n_tokens for r in scan_token_files(spark, path, SEPARATOR).collect()}
    assert set(found) == {0, 1, 2, 3, 10, None}
    assert found[10] == 0 and found[None] == 2 and min(found[i] for i in range(4)) > 1000


def test_both_ways_of_tokenising_agree(monkeypatch):
    ranks = read_ranks(MULTI_VOCABULARY)
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    rnd = random.Random(4)
    texts = ["\n" * 500, " " * 500 + "x", "a" + "\r\n \t" * 300 + "b", "　" * 300, "", None]
    texts += ["".join(rnd.choice(["word ", "é", "  ", "\n", " " * 40]) for _ in range(200)) for _ in range(20)]
    monkeypatch.setattr(separator_scan, "LONG_SPACE", 20)
    separator_scan._long_space.cache_clear()
    for text in texts:
        got = token_ids(text, MULTI_VOCABULARY, public_tokenizers.PATTERN)
        assert got == library.encode_ordinary(text or "")
    separator_scan._long_space.cache_clear()


def plain_uncovered(spans):
    kept = []
    for span in sorted(spans, key=lambda x: (-x[0], x[1], x[2])):
        if not any(o[0] > span[0] and o[2] < span[3] and span[2] < o[3] for o in kept):
            kept.append(span)
    return kept


@pytest.mark.parametrize("seed", range(20))
def test_uncovered_spans_equal_plain(seed):
    rnd = random.Random(seed)
    spans = set()
    for _ in range(rnd.randrange(1, 120)):
        first = rnd.randrange(150)
        spans.add((rnd.randrange(1, 9), rnd.randrange(4), first, first + rnd.randrange(1, 20)))
    spans = list(spans)
    assert sorted(_uncovered(spans)) == sorted(plain_uncovered(spans))


def test_spans_equal_plain_and_grow_with_the_text():
    scanner = LicenceScanner(TEMPLATES, PHRASES, 4, 12, 0.5)
    rnd = random.Random(8)
    notices = [text.lower().replace("-", " ").split() for _, text in TEMPLATES]

    def words(n):
        out = []
        for _ in range(n):
            notice = rnd.choice(notices)
            cut = rnd.randrange(len(notice))
            out += notice if rnd.random() < 0.6 else notice[:cut]
            out += [f"w{rnd.randrange(99)}" for _ in range(rnd.randrange(4))]
        return [word.strip('.,();:"').encode() for word in out]

    seconds = []
    for n in (2_000, 16_000):
        text = words(n)
        started = time.perf_counter()
        found = scanner.spans(text)
        seconds.append(time.perf_counter() - started)
        assert len(found) > n / 3
    assert seconds[1] < 24 * seconds[0]  # eight times the text; the square would be 64


def test_modifiers_and_identifiers(spark):
    cc = "This work is licensed under a Creative Commons Attribution"
    wanted = {
        "cc-by-nd": [f"{cc}-NoDerivatives 4.0 International License", "Licensed under CC BY-ND 4.0."],
        "cc-by-nc-sa": [f"{cc}-NonCommercial-ShareAlike 4.0 License"],
        "cc-by-nc-nd": [f"{cc}-NonCommercial-NoDerivatives 4.0 License"],
        "cc-by-sa": ["Licensed under CC BY-SA 4.0."],
        "gpl": ["Licensed under the GNU General Public License v3.0"],
        "mit": ["x SPDX-License-Identifier: MIT y"],
        "apache-2": ["SPDX-License-Identifier: Apache-2.0"],
        "": ["SPDX-License-Identifier: Foo", "Licensed under CC"],
    }
    texts = [(label, text) for label, all_of in wanted.items() for text in all_of]
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(texts)], "doc_id long, text string")
    got = [r.labels for r in scan_licences(df).orderBy("doc_id").collect()]
    assert got == [label for label, _ in texts]


def test_a_document_of_ten_thousand_notices(spark):
    notice = "Released under the MIT License. Licensed under CC BY-NC 4.0. And so on. "
    df = spark.createDataFrame([(1, notice * 10_000)], "doc_id long, text string")
    (row,) = scan_licences(df).collect()
    assert row.labels == "cc-by-nc,mit" and row.n_base == 20_000 and len(row.spans) >= 10_000
