"""Operations on training text: filters, scans, near copies, packing and token files."""
