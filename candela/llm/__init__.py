"""Operators for preparing language-model training data.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
Conventions shared by all operators:

* the columns they read are named by arguments; every other column of the
  input is ignored unless it is listed in ``keep``, so extra columns, also ones
  named like an operator's own, change nothing;
* a null text is an empty text;
* rows that repeat give repeated results, whatever their order.
"""
