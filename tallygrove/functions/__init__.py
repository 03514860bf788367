from tallygrove.functions.linear import argmax, dot, first_infinite, largest, sigmoid_pair, softmax
from tallygrove.functions.names import named
from tallygrove.functions.rates import METRICS

__all__ = ["METRICS", "argmax", "dot", "named", "first_infinite", "largest", "sigmoid_pair", "softmax"]
