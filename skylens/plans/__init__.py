"""Job-level plans: analytics runs, Silver versions, archive reprocessing, serving publication."""
