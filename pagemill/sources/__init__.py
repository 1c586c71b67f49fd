"""Readers and writers: JSONL and JSON documents, OCR word tables, images, chapter feeds."""
