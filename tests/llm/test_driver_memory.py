"""What the driver keeps between queries."""

from kinspark.llm import shared


def test_native_memory_is_given_back_by_small_tables_too(spark, monkeypatch):
    """Before, nothing was given back, and sweeps passed over small tables: the driver grew with each query."""
    assert shared.release_native_memory(spark)
    calls = []
    monkeypatch.setattr(shared, "release_native_memory", calls.append)
    scratch = shared.Scratch(spark, "small")
    scratch.sweep()
    assert len(calls) == 1
    for k in range(shared.RELEASE_TABLES):
        scratch.table(f"t{k}", spark.range(1))
    assert len(calls) == 2
