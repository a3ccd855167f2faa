"""Operators for training-data texts and learned matching; nothing outside
this subpackage imports it."""
