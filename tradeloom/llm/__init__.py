"""Operators for preparing training text at scale; nothing else in the library imports this folder."""

from pyspark import cloudpickle

import tradeloom.llm as _self

# Tasks get this folder's functions by value, so executors need no copy of it.
cloudpickle.register_pickle_by_value(_self)
