"""Functions that run in tasks reach executors that do not have the package."""

import subprocess
import sys

from pyspark import cloudpickle

from corpusmill.operators.chunk import _block_map
from corpusmill.operators.collection import _best_of, _merge_best
from corpusmill.workload.documents import _dialogue_parser


def test_functions_travel_by_value(tmp_path):
    shipped = tmp_path / "functions"
    shipped.write_bytes(
        cloudpickle.dumps([_block_map, _best_of, _merge_best, _dialogue_parser])
    )
    code = (
        "import pickle, sys; functions = pickle.load(open(sys.argv[1], 'rb')); "
        "assert 'corpusmill' not in sys.modules; print(functions[3](b'a\\n\\nb'))"
    )
    run = subprocess.run(
        [sys.executable, "-c", code, str(shipped)], cwd=tmp_path, capture_output=True, text=True,
        timeout=60,
    )
    assert run.stdout.strip() == "[('NarrativeText', 'a', 1), ('NarrativeText', 'b', 2)]", run.stderr


def test_streaming_frames_take_the_same_operators(spark):
    from corpusmill.plans.flow import DocumentFlow

    stored = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    stream = spark.readStream.schema(stored.schema).parquet("/root/testdata/sf0.001/documents*.parquet")
    flow = DocumentFlow("text", content="text", dim=16)
    query = (
        flow.points(stream).writeStream.format("memory").queryName("streamed_points")
        .trigger(availableNow=True).start()
    )
    assert query.awaitTermination(120)
    assert spark.table("streamed_points").count() == flow.points(stored).count()
