from stratalake.functions.columns import column, decode, gap, lenient_cast, normalise_code, target_of_year

__all__ = ["column", "decode", "gap", "lenient_cast", "normalise_code", "target_of_year"]
