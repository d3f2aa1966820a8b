"""Writers and table maintenance."""
