"""No broker is reachable in tests, so these look at what Spark would be asked."""

from envstream.sinks.outputs import write_topic
from envstream.sources.kafka import Topics, backfill_topics, read_topic
from envstream.streaming.queries import start_topic

TOPICS = Topics("host:1", "air", "weather", group_id="g", max_offsets=500, extra={"failOnDataLoss": "false"})


class Recorder:
    """Takes the place of a reader or writer and notes the calls."""

    def __init__(self):
        self.calls = {}

    def __getattr__(self, name):
        def call(*args, **named):
            if name == "option":
                self.calls.setdefault("options", {})[args[0]] = args[1]
            elif name == "options":
                self.calls.setdefault("options", {}).update(named)
            else:
                self.calls[name] = args or named or True
            return self

        return call


class Holder:
    def __init__(self):
        self.read = self.readStream = self.write = self.writeStream = Recorder()


def test_stream_of_one_topic():
    spark = Holder()
    read_topic(spark, TOPICS, "air")
    assert spark.readStream.calls["format"] == ("kafka",)
    assert spark.readStream.calls["options"] == {
        "kafka.bootstrap.servers": "host:1", "subscribe": "air", "startingOffsets": "latest",
        "kafka.group.id": "g", "maxOffsetsPerTrigger": "500", "failOnDataLoss": "false",
    }


def test_backfill_of_both_topics():
    spark = Holder()
    backfill_topics(spark, TOPICS)
    options = spark.read.calls["options"]
    assert options["subscribe"] == "air,weather"
    assert (options["startingOffsets"], options["endingOffsets"]) == ("earliest", "latest")
    assert "maxOffsetsPerTrigger" not in options and options["kafka.group.id"] == "g"


def test_writers():
    frame = Holder()
    write_topic(frame, "host:1", "air")
    assert frame.write.calls["options"] == {"kafka.bootstrap.servers": "host:1", "topic": "air"}
    frame = Holder()
    write_topic(frame, "host:1")
    assert "topic" not in frame.write.calls["options"] and frame.write.calls["save"]
    frame = Holder()
    start_topic(frame, "host:1", "air", "/state", drain=True)
    assert frame.writeStream.calls["options"] == {
        "checkpointLocation": "/state", "kafka.bootstrap.servers": "host:1", "topic": "air",
    }
    assert frame.writeStream.calls["trigger"] == {"availableNow": True}
