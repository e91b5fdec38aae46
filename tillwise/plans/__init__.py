"""Reports, segmentation, forecasting, SQL guard and the end-to-end pipeline."""
