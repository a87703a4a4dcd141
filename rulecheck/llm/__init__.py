"""Training-data operators: chat formatting, fingerprints, quality and language
models, substring and near-duplicate removal, archives, packing, encoding,
conversation tries, page text, vector codes."""
