"""Operators for training-data pipelines over text, vectors and token files.

Each module holds one operator. Inputs are copied under internal names first,
and the caller's columns travel in one struct named ``row``, so extra columns
of any name neither clash nor get lost.
"""
