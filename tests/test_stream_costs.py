"""What a replay works out once, and how many tasks take part in it."""

from envstream.checks import queries as Q
from envstream.session import streaming_session
from envstream.sinks import outputs
from envstream.streaming import table_writer
from envstream.streaming.batch_parts import BatchParts


def test_a_batch_that_is_run_again_goes_through_the_state_once(spark, sf_dir, monkeypatch):
    kept, write = [], BatchParts.write

    def noted(self, part, batch_id):
        kept.append((batch_id, part.storageLevel.useMemory))
        write(self, part, batch_id)

    monkeypatch.setattr(BatchParts, "write", noted)
    Q.scaled_from_history(spark, sf_dir)
    assert kept and all(by_memory for _, by_memory in kept)
    assert all(sum(b == batch_id for b, _ in kept) == 2 for batch_id, _ in kept)


def test_every_core_has_a_file_of_a_batch(spark, sf_dir, monkeypatch):
    parts, write = [], outputs.write_feed

    def noted(messages, path):
        parts.append(messages.rdd.getNumPartitions())
        write(messages, path)

    monkeypatch.setattr(outputs, "write_feed", noted)
    Q.stream_join_replayed(spark, sf_dir)
    assert parts and set(parts) == {2 * spark.sparkContext.defaultParallelism}


def test_both_runs_of_a_batch_share_its_decoded_rows(spark, sf_dir, monkeypatch):
    decoded, air_rows = [], table_writer.air_rows

    def noted(messages):
        decoded.append(1)
        return air_rows(messages)

    monkeypatch.setattr(table_writer, "air_rows", noted)
    ledger = Q.ledger_after_crash(spark, sf_dir)
    assert len(decoded) == ledger.count()


def test_state_stores_do_not_count_their_rows(spark):
    name = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"
    assert streaming_session(spark).conf.get(name) == "false"
