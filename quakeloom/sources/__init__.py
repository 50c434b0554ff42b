"""Inputs and outputs: payload pages, topic messages, collections, statistics."""
