import json

import pytest

from quarrylamp import cli
from quarrylamp.operators import rag, runs, search

NOTES = {
    "src/a.txt": "The collector lost samples.\n\nLatency rose when the buffer was full and nobody looked.",
    "src/sub/b.html": "<p>The parser stored every packet.</p><p>The collector was idle and no samples were lost at the site.</p>",
    "src/c.json": '{"note": "signature of the collector", "n": 3}',
    "src/empty.txt": "",
    "src/x.bin": "\x00",
}
TOPIC = "topic: loss\nhigh_signal: [collector]\nmedium_signal: [samples]\nlow_signal: [latency]\n"
BATTERY = """sections:
- id: net
  name: Network
  topics:
  - {id: loss, topic: Loss, question: what lost samples, terms: [collector, samples], fields: [CAUSE]}
  - {id: delay, topic: Delay, question: what raised latency, terms: [latency], fields: [CAUSE], use_union_context: true}
"""


@pytest.fixture(scope="module")
def home(tmp_path_factory):
    home = tmp_path_factory.mktemp("home")
    for name, text in NOTES.items():
        (home / name).parent.mkdir(parents=True, exist_ok=True)
        (home / name).write_text(text)
    (home / "loss.yaml").write_text(TOPIC)
    (home / "none.yaml").write_text("topic: none\n")
    (home / "battery.yaml").write_text(BATTERY)
    return home


def test_from_files_to_answers(spark, home, capsys):
    def run(*args):
        code = cli.main([args[0], "--data", str(home / "data"), *map(str, args[1:])], spark)
        return code, capsys.readouterr().out

    assert run("extract")[0] == 1 and run("query", "collector")[0] == 1
    assert run("inventory", home / "src")[0] == 0 and run("inventory", home / "nowhere")[0] == 1
    assert run("extract")[0] == 0 and run("extract")[0] == 0
    topic = ("--topic", home / "loss.yaml")
    assert run("triage", "--topic", home / "none.yaml")[0] == 1 and run("tier", *topic)[0] == 1
    assert run("triage", *topic)[0] == 0
    code, out = run("tier", *topic)
    assert code == 0 and "tier1\t3" in out
    assert run("index", "--dry-run")[1].split() == ["new", "3"]
    assert run("index")[0] == 0
    assert run("index", "--dry-run")[1].split() == ["unchanged", "3"]
    code, out = run("query", "collector samples", "--json")
    docs = [json.loads(line) for line in out.splitlines()]
    assert code == 0 and len(docs) == 3 and docs[0]["score"] >= docs[-1]["score"]
    assert run("query")[0] == 2 and run("query", "--show-doc", "nothing")[0] == 1 and run("query", "--show-doc", docs[0]["doc_id"])[0] == 0
    assert "collector" in run("ask", "which collector lost samples")[1] and "nothing found" in run("ask", "unseenword")[1]
    assert run("battery", home / "battery.yaml", "--topic", "nope")[0] == 1 and run("battery", home / "battery.yaml")[0] == 0
    report = "".join(p.read_text() for p in (home / "data/out/battery").glob("part-*"))
    assert report.count("## Network: ") == 2
    assert run("analyze", *topic)[0] == 0 and run("translate", *topic)[0] == 0
    assert len(run("translate", *topic)[1].splitlines()) == 3  # all done before
    assert run("ingest", home / "src", *topic)[0] == 0


def test_audit_and_attachments(spark, home, capsys):
    deck = home / "decks"
    deck.mkdir()
    (deck / "d.pdf").write_bytes(b"<</Type /Pages /Count 3>>")
    (home / "md").mkdir()
    (home / "md/x_t.md").write_text("**Source path:** `d.pdf`\n**Images attached:** 1\n\n## Slide 1\nword\n")
    assert cli.main(["audit", str(deck), str(home / "md")], spark) == 1 and "FAIL_SHORT" in capsys.readouterr().out
    (home / "issues").mkdir()
    (home / "issues/i1.json").write_text(json.dumps({"fields": {"attachment": [{"id": "7", "filename": "gone.pdf"}]}}))
    assert cli.main(["attachments", str(home / "issues")], spark) == 0 and capsys.readouterr().out.split() == ["i1", "7", "gone.pdf"]


def test_runs_limit_images_and_keep_failures(spark):
    class Model:
        def complete(self, prompt, images=(), max_tokens=None):
            if "p/b" in prompt:
                raise ValueError("no")
            return f"{len(images)} {max_tokens}"

    tier = spark.createDataFrame([("a", "p/a", "en", 9.0), ("b", "p/b", "en", 8.0), ("c", "p/c", "en", 7.0), ("d", "p/d", "en", 1.0)], "id string, path string, lang string, score double")
    rows = [(i, "p", "", "en", 1, 1, t, "", False, "s", 0) for i, t in (("a", "text a"), ("b", "text b"), ("c", ""))]
    kind = "id string, path string, ext string, lang string, char_count bigint, n_elements int, text string, error string, ocr boolean, shard_file string, line_no int"
    records = spark.createDataFrame(rows, kind)
    images = spark.createDataFrame([("a", ["x"] * 40)], "id string, images array<string>")
    out = {r.id: (r.answer, bool(r.error)) for r in runs.analyse(tier, records, "t", Model(), images, max_docs=3).collect()}
    assert out == {"a": ("30 4000", False), "b": (rag.NOT_FOUND, True)}
    one = runs.synthesis(runs.analyse(tier, records, "t", Model(), images), "t", Model()).collect()
    assert len(one) == 1 and one[0].answer == "0 8000"
    done = spark.createDataFrame([("a",)], "id string")
    got = {(r.id, r.target): bool(r.error) for r in runs.translate(tier.where("id < 'c'"), records, Model(), done).collect()}
    assert got == {("b", "en"): True, ("b", "zh"): True}
    index = runs.translation_index(runs.translate(tier.where("id < 'c'"), records, Model()))
    assert [(r.id, r.targets) for r in index.collect()] == [("a", ["en", "zh"])]


def test_union_context_takes_the_documents_of_all_topics(spark):
    chunks = [(f"d{i}:0000", f"d{i}", f"p/d{i}", "en", t, 0, len(t)) for i, t in enumerate(["collector lost", "samples lost", "latency rose", "nothing"])]
    df = spark.createDataFrame(chunks, "chunk_id string, doc_id string, path string, lang string, text string, char_start int, char_end int")
    records = df.selectExpr("doc_id AS id", "path", "'.txt' AS ext", "lang", "text", "'s' AS shard_file", "0 AS line_no")
    data = {"sections": [{"id": "s", "name": "S", "topics": [
        {"id": "own", "topic": "O", "question": "collector", "terms": [], "fields": []}, {"id": "all", "topic": "A", "question": "latency", "terms": ["samples"], "fields": [], "use_union_context": True}]}]}
    out = {r.id: r.answer for r in runs.answer_battery(spark, df, records, data, rag.EchoCompleter(2000)).collect()}
    assert out["own"].count("### Source") == 1 and out["all"].count("### Source") == 3
    q = search.Query("q", "collector latency")
    assert len(runs.answer(df, records, q, rag.EchoCompleter(2000), num_ctx=2001).collect()[0].answer.split("### Source")) == 2
