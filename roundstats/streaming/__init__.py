"""Streaming access to the word count.

The reference has no streaming; its word count reads a folder of text
files once. Here the same operator (F9 tokens + A9 count) also runs over a
folder that keeps receiving files, as a Structured Streaming query.
"""

from roundstats.streaming.words import stream_word_count

__all__ = ["stream_word_count"]
