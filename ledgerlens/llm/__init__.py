"""Preparation of training data: formatting, filtering, deduplication, decontamination and mixing of documents."""
