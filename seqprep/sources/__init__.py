"""What is read and written: datasets, chat records, run logs."""
