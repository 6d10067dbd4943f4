"""Sources: message streams (Kafka or file replay), layer-table scans, demo feeds."""
