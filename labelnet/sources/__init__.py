"""Readers and writers (any Hadoop-FS URI: file:, hdfs:, s3a:, gs:)."""
