"""Streaming counterpart of the CSV-folder source.

The original job is batch only (no watermark, window or state). Its input is
a folder of CSV files, which Structured Streaming can read as files arrive.
Cleaning, labelling and a fitted model's ``transform`` are all stateless row
expressions, so the batch operators apply unchanged to such a stream; this
module only wires them up. No operator here has semantics of its own.
"""

from catlens.streaming.scoring import read_csv_dir_stream, score_stream, write_scored_stream

__all__ = ["read_csv_dir_stream", "score_stream", "write_scored_stream"]
