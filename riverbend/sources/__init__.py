"""Sources: driver tables, Kafka-shaped envelopes, files, change feeds, protobuf."""
