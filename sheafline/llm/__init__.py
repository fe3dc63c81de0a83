"""Operators of a training-data pipeline, each a function ``DataFrame -> DataFrame``.

``queries`` registers one query per operator; the modules hold the operators.
"""
