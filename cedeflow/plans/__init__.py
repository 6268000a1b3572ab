"""Which reports each block of business gets."""
