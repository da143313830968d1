"""Operators of a training-data pipeline. Nothing outside this subpackage imports it.

Every operator accepts any column null, empty and very long texts, tied and repeated rows, empty tables and extra
columns; what each of these gives is stated in the operator's docstring.
"""
