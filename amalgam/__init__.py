"""amalgam: DataFrame operators that merge overlapping reference tables into one."""
