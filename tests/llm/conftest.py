"""Small tables with every kind of dirt that each operator must stand: nulls, empty texts, ties, repeated rows, extra
columns with clashing names."""

import pytest


@pytest.fixture(scope="session")
def make_records(spark):
    kind = "id string, path string, ext string, lang string, char_count bigint, n_elements int, text string, error string, ocr boolean, shard_file string, line_no int, word string, n bigint, rank int"

    def make(rows, lang="en"):
        out = []
        for i, r in enumerate(rows):
            rid, text = r[:2]
            label = r[2] if len(r) > 2 else lang
            out.append((rid, f"src/{rid}.pdf" if rid else None, ".pdf", label, len(text or ""), 1, text, "", None, "s0.jsonl", i, "clash", 7, 1))
        return spark.createDataFrame(out, kind)

    return make
