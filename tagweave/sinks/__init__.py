"""Writers and record layouts."""
