"""Column-expression codecs: values, keys, records, epoch conversions."""
