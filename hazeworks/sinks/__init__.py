"""Writers. All of them are distributed; nothing passes through the driver."""
