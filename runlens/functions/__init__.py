"""Column-level functions: ids, paths, patches, commands, texts, keyed draws."""
