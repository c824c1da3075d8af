"""Training-data operators: language identification, decontamination, BPE,
WARC, line / substring / exact / near-duplicate removal, HTML extraction and
quality classification.  Nothing outside this subpackage imports it."""
