"""Each public function as the first thing a session does, with the repository on the driver's import path alone."""

import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
import public_tokenizers
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from ledgerlake.llm import chat, decontamination, manifest, near_dedup, negatives, neighbours, packing, pii, quality, repeats, secrets, toxicity, urls

path = public_tokenizers.path("word_bpe_49k.json")
texts = [(i, f"text {i} a b c d e f g h") for i in range(4)]
docs = lambda s: s.createDataFrame(texts, "doc_id long, text string")
labels = lambda s: s.createDataFrame([(0, 0, 1), (1, 1, 0)], "doc_id long, toxic int, quality int")
vectors = lambda s: s.createDataFrame([(i, [1.0, float(i)], i % 2) for i in range(6)], "vec_id long, embedding array<double>, label int")
calls = {
    "near_duplicates": lambda s: near_dedup.near_duplicates(docs(s)),
    "pack": lambda s: packing.pack(docs(s), path),
    "padded": lambda s: packing.padded(s.createDataFrame([], "sequence_id long, pieces " + packing._PIECES + ", ids binary")),
    "with_surrogates": lambda s: pii.with_surrogates(docs(s), b"key"),
    "formatted": lambda s: chat.formatted(s.createDataFrame([(1, 0, "user", "hi")], "conv_id long, turn long, role string, text string"), path),
    "contamination": lambda s: decontamination.contamination(docs(s), s.createDataFrame([("i", "a b c")], "item_id string, text string")),
    "repeats": lambda s: repeats.kept_bytes(repeats.repeats(docs(s))),
    "nearest": lambda s: neighbours.nearest(vectors(s), F.lit(True)),
    "toxicity": lambda s: toxicity.scored(docs(s), toxicity.train(docs(s), labels(s), F.lit(True))),
    "quality": lambda s: quality.scored(docs(s), quality.train(docs(s), labels(s), F.lit(True))),
    "judged": lambda s: urls.judged(s.createDataFrame([(1, "http://a.b/")], "page_id long, url string"), s.createDataFrame([("b", "/", "block")], "host string, path string, verdict string")),
    "scan": lambda s: secrets.scan(docs(s)),
    "manifest": lambda s: manifest.manifest(docs(s), F.col("doc_id"), F.lit("g"), [F.col("text")]),
    "hard_negatives": lambda s: negatives.hard_negatives(vectors(s), F.lit(True), F.col("label")),
}
for name, call in calls.items():
    s = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", sys.argv[2]).getOrCreate()
    call(s).collect()
    s.stop()
    print("done", name)
"""


def test_functions_called_first():
    with tempfile.TemporaryDirectory() as folder:
        environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
        ran = subprocess.run([sys.executable, "-c", SCRIPT, ROOT, f"{folder}/shared"], cwd=folder, env=environment, capture_output=True, text=True, timeout=600)
        assert ran.returncode == 0, ran.stderr[-3000:]
        assert ran.stdout.count("done") == 14
