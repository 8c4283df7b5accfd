"""Histories and requests are whole: every earlier message, its role and text."""

import pytest

import __spark_entry__ as E


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("conversations"))
    rows = [(1, 0, "system", "be brief"), (1, 1, "user", "hi"), (1, 2, "assistant", "hello"), (1, 3, "user", "and"),
            (1, 4, "assistant", None), (1, 5, "user", "reset!!"), (1, 6, "user", "more"), (2, 0, "user", "one")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{d}/conversations.parquet")
    return d


def test_history_fold_gives_the_roles_of_the_whole_history(spark, sf_dir):
    got = {(r.conv_id, r.turn): (r.segment, r.n_history, r.roles, r.history_chars, r.n_user_messages, r.chunk, r.chunk_offset)
           for r in E.queries()["history_fold"](spark, sf_dir).collect()}
    assert got == {(1, 1): (0, 0, "", 0, 0, 0, 0), (1, 3): (0, 2, "user,assistant", 7, 1, 0, 2),
                   (1, 6): (1, 0, "", 0, 0, 0, 0), (2, 0): (0, 0, "", 0, 0, 0, 0)}


def test_message_assembly_gives_the_roles_of_the_whole_request(spark, sf_dir):
    from arbiter.sources.fixtures import FEW_SHOTS
    shots = sum(len(c) for _, c in FEW_SHOTS)
    got = {(r.conv_id, r.turn): (r.n_messages, r.roles, r.content_chars - shots, r.n_user_messages)
           for r in E.queries()["message_assembly"](spark, sf_dir).collect()}
    assert got == {(1, 1): (4, "system,user,assistant,user", 10, 2),
                   (1, 3): (6, "system,user,assistant,user,assistant,user", 18, 3),
                   (1, 6): (4, "system,user,assistant,user", 12, 2),
                   (2, 0): (4, "system,user,assistant,user", 31, 2)}
