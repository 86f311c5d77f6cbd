"""Sources: workbook cells (S1-S3) and checked single-sheet reads."""
