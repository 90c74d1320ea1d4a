from kotonoha.llm import queries_groups, splits


def test_quarters_are_batches_of_their_own(spark, monkeypatch):
    taken = []
    monkeypatch.setattr(splits.ComponentTable, "add", lambda self, ties: taken.append(ties.count()))
    queries_groups._components(spark, "/root/testdata/sf0.001")
    assert len(taken) > 2 and all(taken)
