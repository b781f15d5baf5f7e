"""Training-data operators: language id, chat formatting, BPE, packing, dedup, licences, joins, sharding, sketches, quality."""
